"""One registered query for each operator, over its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlane.llm import bpe, chat, decontaminate, hard_negatives, html_text, langid, permutation_index, prefix_trie, simhash, token_counts, token_files, urls, warc
from silverlane.llm.store import pick, shared_folder


#: Rules of the URL filter, and domains that are blocked where no rule fits.
ALLOWED = ("org/", "com/fr/")
BLOCKED = ("example.org/es/", "example.org/en/1", "com/de/")
BLOCKED_HOSTS = tuple(
    f"{name}.example.{top}"
    for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth one."""
    vectors = _table(spark, sf_dir, "embeddings")
    return permutation_index.nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentencepiece token counts of all documents."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), model)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of benchmark items inside all documents."""
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.digests(found)


def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-modified revisits of all pages, resolved to earlier full responses."""
    return warc.shown(warc.resolve_revisits(warc.captures_of(_table(spark, sf_dir, "pages"))))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of control strings, formatted, encoded and read back."""
    said = "</s>[INST] ok [/INST]"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    segments = chat.format_conversations(rows.union(own), public_tokenizers.path("byte_bpe_50k.json"))
    found = chat.read_back(segments)
    return found.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents, and the texts they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path))


def in_fold(doc_id: str, fold: int, folds: int = 4) -> Column:
    """Whether the document is in this fold; a null id is in none."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, by a model that has not seen those of fold 2."""
    docs = pick(_table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", lang="lang")
    model = langid.fit(docs, ~in_fold("doc_id", 2))
    found = langid.predict(docs, model)
    return found.select("doc_id", in_fold("doc_id", 2).alias("held_out"), "lang_pred", "score", "languages")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by SimHash."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, distance=4)
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages, by a model trained on some of them and on labelled layouts."""
    pages = _table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule that fits each page's url, and the verdict."""
    return urls.judge(_table(spark, sf_dir, "pages"), ALLOWED, BLOCKED, BLOCKED_HOSTS)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, where every seventh has the label after its own."""
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, relabel=relabel)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each begun with up to eight turns of the first of its five."""
    conv_id = F.col("conv_id")
    head, base = F.crc32(conv_id.cast("string")) % 9, conv_id - conv_id % 5
    nodes = prefix_trie.build(_table(spark, sf_dir, "conversations"), head, base, most=8)
    return nodes.drop("turn_conv_id", "turn_place")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written as plane-shuffled blocks and read back."""
    path = f"{shared_folder(spark)}/llm/ids-{uuid.uuid4().hex}"
    token_files.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_digests(spark, path)


ALL = [op1_permutation_index, op2_token_counts, op3_decontaminate, op4_revisits, op5_chat, op6_bpe, op7_language_id, op8_simhash, op9_html_text, op10_url_filter, op11_hard_negatives, op12_prefix_trie, op13_token_files]
SQL = {
    "op3_decontaminate": decontaminate.SQL,
    "op4_revisits": warc.SQL,
    "op5_chat": chat.sql(),
    "op10_url_filter": urls.sql(ALLOWED, BLOCKED, BLOCKED_HOSTS),
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
