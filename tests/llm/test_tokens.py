from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silverlane.llm import bpe, token_counts


def test_counts_equal_the_library(spark, documents, odd_texts, piece_bpe):
    texts = odd_texts + odd_texts[:5]  # repeated rows
    rows = [(k % 20, t) for k, t in enumerate(texts)] + [(None, "no id")]
    library = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
    wanted = sorted(
        (str(k), len((t or "").encode()), n := len(library.encode(t or "")), n > 100) for k, t in rows
    )
    for frequent in (0, 5, 100_000):  # all pre-tokens joined, some, none
        got = token_counts.count_tokens(documents(rows), piece_bpe, over=100, frequent=frequent).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == wanted


def test_counts_of_empty_table_and_clashing_columns(documents, piece_bpe):
    docs = documents([(1, "some text here")])
    clash = docs.withColumn("token", F.lit(1)).withColumn("row", F.lit("x")).withColumn("n_tokens", F.lit(0)).withColumn("TEXT2", F.lit(1))
    clash = clash.toDF(*[c if c != "TEXT2" else "TEXT" for c in clash.columns])
    assert token_counts.count_tokens(clash, piece_bpe).first().n_tokens == 3
    assert token_counts.count_tokens(documents([]), piece_bpe).collect() == []


@settings(max_examples=200, deadline=None, derandomize=True)
@given(text=st.text(max_size=60))
def test_pre_tokens_add_up(text):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, pattern = _loaded(path)
    before = len(library.encode(token_counts.ANCHOR))
    parts = token_counts.split(pattern, text)
    assert "".join(parts) == (" " + text if text else "")
    assert sum(len(library.encode(token_counts.ANCHOR + p)) - before for p in parts) == len(library.encode(text))


_cache: dict = {}


def _loaded(path):
    if path not in _cache:
        _cache[path] = token_counts.load(path), token_counts.pre_token_pattern(path)
    return _cache[path]


def test_frequent_tokens_are_bounded(spark):
    rows = [(f" t{k}", k % 50 + 1, 1) for k in range(500)] + [(" " + "x" * 100, 10**6, 1)]
    counted = spark.createDataFrame(rows, "token string, n long, pieces long")
    got = token_counts.frequent_tokens(counted, most=100)
    assert 0 < len(got) <= 100
    assert min(k % 50 + 1 for k in range(500) if f" t{k}" in got) >= 37 and " " + "x" * 100 not in got


def alphabet():
    return list("abc thE.,'s  \n\t\x1c\x85 　éñßÀ0123٣½²中🙂́'ll're") + ["<|endoftext|>", " the", "ing", "ﬁ", "Ⅷ", "a" * 9, "𝒜"]


def test_bpe_equals_the_library(byte_bpe):
    rng = random.Random(3)
    texts = ["".join(rng.choice(alphabet()) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    codec, library = bpe.Codec(byte_bpe), Tokenizer.from_file(byte_bpe)
    ids, sizes = codec.encode(texts)
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == list(map(len, wanted))
    assert ids.tolist() == [i for w in wanted for i in w]
    assert codec.decode(ids, sizes) == [library.decode(w, skip_special_tokens=False) for w in wanted]
    again, _ = codec.encode(texts)  # from what is remembered
    assert (again == ids).all()


def test_bpe_decodes_any_ids(byte_bpe):
    codec, library = bpe.Codec(byte_bpe), Tokenizer.from_file(byte_bpe)
    rng = np.random.default_rng(1)
    lists = [rng.integers(0, 50_257, rng.integers(0, 9)) for _ in range(500)]
    got = codec.decode(np.concatenate(lists), np.array(list(map(len, lists))))
    assert got == [library.decode(x.tolist(), skip_special_tokens=False) for x in lists]
    assert codec.decode(np.array([10**6, -1, 64]), np.array([3])) == [library.decode([64])]


def test_bpe_over_a_table(documents, odd_texts, byte_bpe, monkeypatch):
    rows = [(k % 9, t) for k, t in enumerate(odd_texts * 2)] + [(None, "no id")]
    library = Tokenizer.from_file(byte_bpe)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    wanted = []
    for k, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        wanted.append((str(k), len(ids), digest(",".join(map(str, ids))), digest(t or "")))
    docs = documents(rows).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 1000)
    got = bpe.digests(bpe.decode(bpe.encode(docs, byte_bpe), byte_bpe)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(wanted)
    checked = bpe.encode_checked(docs, byte_bpe).collect()
    assert all(r.exact for r in checked)
    assert sorted((str(r.doc_id), len(r.ids)) for r in checked) == sorted(w[:2] for w in wanted)
    assert bpe.digests(bpe.decode(bpe.encode(documents([]), byte_bpe), byte_bpe)).collect() == []


def test_decode_of_null_ids(spark, byte_bpe):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [64])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(rows, byte_bpe).collect()} == {1: "", 2: "", 3: "a"}


@pytest.mark.parametrize("text", ["aaaa", "aaaaa", "abab", "aabaab"])
def test_overlapping_pairs(text, byte_bpe):
    codec, library = bpe.Codec(byte_bpe), Tokenizer.from_file(byte_bpe)
    assert codec.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
