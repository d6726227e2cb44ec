"""The corpus pipeline: documents in, token ids of the documents worth training on out.

Each stage takes what its predecessor kept, as a written table, and all but the last give rows of
documents as they came, but for `lang`, which is the predicted language from the first stage on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlane.llm import bpe, decontaminate, langid, simhash
from silverlane.llm.queries import in_fold
from silverlane.llm.store import pick, stored


def one_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of which one language has half of the words or more, and puts that language, as found, into `lang`.

    Null texts go, those without letters, and mixtures in which no language reaches half.
    """
    labelled = pick(docs, doc_id="doc_id", text="text", lang="lang")
    return langid.accepted(docs, langid.fit(labelled, ~in_fold("doc_id", 2)))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near-duplicates."""
    return simhash.one_of_each(docs, shingle=4, distance=4)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a passage of a benchmark item occurs."""
    return decontaminate.clean_only(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_chars, n_tokens, ids); a document whose ids do not decode to its text is dropped."""
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang", source="source", n_chars="n_chars")
    kept = F.struct("doc_id", "lang", "source", "n_chars").alias("doc")
    coded = bpe.encode_checked(rows.select(kept, "text"), public_tokenizers.path("byte_bpe_50k.json"), doc_id="doc")
    same = coded.where("exact")
    return same.select("doc_id.doc_id", "doc_id.lang", "doc_id.source", "doc_id.n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", one_language),
    ("SimHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmarks),
    ("BPE encoding and decoding", tokens),
]
#: The model of the first stage and the fingerprints of the second are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
