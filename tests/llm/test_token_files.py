from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silverlane.llm import token_files


@pytest.fixture(scope="session")
def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def expected(rows, path, end_id=1):
    """(doc_id, start, n_tokens, crc) by the library, one text after the other."""
    library, out, start = Tokenizer.from_file(path), [], 0
    least = [(k is not None, k or 0, t is not None, (t or "").encode(), t) for k, t in rows]
    for has, k, _, _, text in sorted(least, key=lambda r: r[:4]):
        ids = library.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((k if has else None, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def found(spark, path):
    """The same from the files, by both readers."""
    documents = token_files.read_documents(spark, path).collect()
    assert all(len(r.ids) == 4 * r.n_tokens for r in documents)
    one = sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in documents), key=lambda r: r[1])
    digests = token_files.read_digests(spark, path).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in digests), key=lambda r: r[1]) == one
    return one


@pytest.mark.parametrize("block, bits", [(1, 1), (7, 8), (64, 1), (16_384, 8)])
def test_files_give_back_what_the_library_encodes(spark, documents, odd_texts, word_bpe, where, block, bits):
    texts = odd_texts + ["Σίσυφοσ ΑΣ İi ﬁ ́x é , 'S'll d'x　y z", "a<|endoftext|>b <|startoftext|>"]
    if block == 1:
        texts = [t for t in texts if len(t or "") < 1000]
    rows = [(k % 9, t) for k, t in enumerate(texts)] + [(None, "no id"), (None, None), (3, "twice"), (3, "twice")]
    docs = documents(rows).repartition(5)
    token_files.write(docs, where, word_bpe, block=block, plane_bits=bits)
    assert found(spark, where) == expected(rows, word_bpe)


def test_a_file_that_keeps_white_space_and_clashing_columns(spark, documents, odd_texts, byte_bpe, where):
    rows = list(enumerate(odd_texts))
    docs = documents(rows).withColumn("ids", F.lit(1)).withColumn("part", F.lit(2)).withColumn("T", F.lit(3))
    docs = docs.toDF(*[c if c != "T" else "TEXT" for c in docs.columns])
    token_files.write(docs, where, byte_bpe, block=100, end_id=50256)
    assert found(spark, where) == expected(rows, byte_bpe, 50256)


def test_empty_table(spark, documents, word_bpe, where):
    token_files.write(documents([]), where, word_bpe)
    assert token_files.read_documents(spark, where).collect() == []
    assert token_files.read_index(spark, where).collect() == []


def test_index_and_ranges(spark, documents, word_bpe, where):
    draw = random.Random(4)
    rows = [(k, " ".join(f"w{draw.randrange(50)}" for _ in range(draw.randrange(60)))) for k in range(200)]
    token_files.write(documents(rows).repartition(4), where, word_bpe, block=256)
    library = Tokenizer.from_file(word_bpe)
    every = [i for _, t in rows for i in library.encode(t, add_special_tokens=False).ids + [1]]
    index = token_files.read_index(spark, where).orderBy("start").collect()
    assert [r.start for r in index] == np.cumsum([0, *[r.n_ids for r in index]])[:-1].tolist()
    assert sum(r.n_ids for r in index) == len(every)
    for low, high in ((0, 1), (100, 700), (len(every) - 3, len(every)), (0, len(every))):
        got = token_files.read_range(spark, where, low, high).orderBy("start").collect()
        assert [i for r in got for i in r.ids] == every[low:high]


def test_a_changed_block_is_refused(spark, documents, word_bpe, where):
    token_files.write(documents([(1, "some words of text")]), where, word_bpe)
    row = token_files._blocks(spark, where).first().asDict(recursive=True)
    unpack = zstandard.ZstdDecompressor()
    token_files._checked(row, unpack)
    with pytest.raises(ValueError, match="checksum"):
        token_files._checked(row | {"crc": row["crc"] ^ 1}, unpack)


@settings(max_examples=200, deadline=None, derandomize=True)
@given(ids=st.lists(st.integers(0, 2**32 - 1), max_size=70), bits=st.sampled_from([1, 8]))
def test_planes_round_trip(ids, bits):
    ids = np.array(ids, np.uint32)
    planes = token_files.planes_of(ids, bits, zstandard.ZstdCompressor())
    assert token_files.ids_of(planes, len(ids), bits, zstandard.ZstdDecompressor()).tolist() == ids.tolist()


@settings(max_examples=200, deadline=None, derandomize=True)
@given(parts=st.lists(st.binary(max_size=40), max_size=5))
def test_checksums_of_pieces_combine(parts):
    whole, crc = b"".join(parts), 0
    behind = len(whole)
    for part in parts:
        behind -= len(part)
        crc ^= token_files.crc_before(zlib.crc32(part), behind)
    assert crc == zlib.crc32(whole)


def test_remembered_words_are_bounded(word_bpe, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED_CHARS", 50)
    encoder, library = token_files.Encoder(word_bpe), Tokenizer.from_file(word_bpe)
    texts = [f"word{k} and x{k % 3} " * 3 for k in range(40)]
    for k in range(0, 40, 4):
        ids, sizes = encoder.encode(texts[k : k + 4])
        wanted = [library.encode(t, add_special_tokens=False).ids for t in texts[k : k + 4]]
        assert ids.tolist() == [i for w in wanted for i in w] and sizes.tolist() == list(map(len, wanted))
        assert encoder.held < 50 + 200


@settings(max_examples=400, deadline=None, derandomize=True)
@given(text=st.text(max_size=60) | st.text("aZ é,'.sStTdDmMlLvVrReE1²\x85\xa0\x1c\t\u0130ǅ<|>startofendtext🙂́", max_size=60))
def test_parts_are_encoded_as_the_library_does(text):
    import public_tokenizers

    if "coder" not in _cache:
        path = public_tokenizers.path("word_bpe_49k.json")
        _cache["coder"] = token_files.Encoder(path), Tokenizer.from_file(path)
    encoder, library = _cache["coder"]
    ids, sizes = encoder.encode([text, None, text + " <|endoftext|>x"])
    wanted = [library.encode(t, add_special_tokens=False).ids for t in (text, "", text + " <|endoftext|>x")]
    assert ids.tolist() == [i for w in wanted for i in w] and sizes.tolist() == list(map(len, wanted))


_cache: dict = {}


def test_query_equals_the_library(spark, word_bpe):
    from silverlane.llm.queries import op13_token_files

    tables = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    got = op13_token_files(spark, tables).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == expected(rows, word_bpe)
