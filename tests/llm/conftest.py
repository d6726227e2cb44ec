from __future__ import annotations

import public_tokenizers
import pytest

from pyspark.sql import types as T


@pytest.fixture(scope="session")
def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def piece_bpe() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, lang)."""

    def make(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_texts() -> list[str | None]:
    """Texts at the edges: null, empty, blank, signs, very long, control characters, special strings."""
    return [
        None,
        "",
        " ",
        "\n\t ",
        "...",
        "a",
        "A a",
        "Éa é 中文 ñandú 123 ٣½ ok",
        "\x00\x1c\x85 　​﻿",
        "<|endoftext|> in <|endoftext|><s>text</s>",
        "don't we'll I'm 'tis  two  spaces   three ",
        "▁under▁line ▁ ▁▁",
        "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 50,
        "word " * 30_000,
        "𝒜𐒠🙂 é",
        "tab\tand\r\nlines\n\n\nend ",
    ]
