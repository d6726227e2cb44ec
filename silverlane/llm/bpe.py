"""Byte-level BPE encoding and decoding over a pair occurrence index.

A block of texts is cut into pre-tokens, and the distinct ones are merged together: an index maps each
pair of neighbouring symbols to all its places in the block. Ranks are applied in ascending order, each
at all its places at once, and the lists of the pairs that a merge makes or breaks are updated. A merge
only makes pairs of higher rank, so every rank is visited once.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.llm.store import pick

#: Characters of text that are indexed together, and pre-tokens a task remembers between blocks.
BLOCK_CHARS = 3_000_000
REMEMBERED = 250_000
#: Runs that are copied at once.
STEP = 200_000


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in the vocabulary: itself, or the next from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


#: Texts with characters below this code point only are split by the faster of two equal patterns.
LATIN = 0x250
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def latin_pattern() -> re.Pattern:
    """PRE_TOKENS with its Unicode properties written out as ranges, for `re`; right below LATIN."""
    every = "".join(map(chr, range(LATIN)))
    letter, digit, space = (
        "".join(f"{re.escape(run[0])}-{re.escape(run[-1])}" for run in regex.findall(f"{kind}+", every))
        for kind in (r"\p{L}", r"\p{N}", r"\p{White_Space}")
    )
    return re.compile(
        f" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def gather(table: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """table[start : start + size] for each pair of start and size, one after the other."""
    out, done = np.empty(sizes.sum(), table.dtype), 0
    for k in range(0, len(sizes), STEP):
        some = sizes[k : k + STEP]
        ends = np.cumsum(some)
        at = np.repeat(starts[k : k + STEP] - (ends - some), some)
        at += np.arange(len(at))
        out[done : done + len(at)] = table[at]
        done += len(at)
    return out


class Codec:
    """Vocabulary, merges and special strings of a tokenizer file, and what was encoded so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        signs = byte_signs()
        byte_of = {sign: bytes([b]) for b, sign in enumerate(signs)}
        self.first = np.array([vocab[sign] for sign in signs], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        bytes_of = {i: b"".join(byte_of[c] for c in token) for token, i in vocab.items()}
        bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.n_ids = max(bytes_of) + 1
        spelled = [bytes_of.get(i, b"") for i in range(self.n_ids)]
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled = np.array([len(s) for s in spelled])
        self.spell_at = np.cumsum(self.spelled) - self.spelled
        split = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        #: Of each rank: the left, right and made symbol; and the pairs as sorted numbers with their ranks.
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in split]
        keys = np.array([a * self.n_ids + b for a, b, _ in self.merges], np.int64)
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.latin, self.beyond = latin_pattern(), re.compile(f"[^\0-{chr(LATIN - 1)}]")
        self.forget()

    def forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(count().__next__)
        self.ids, self.sizes = np.array([*self.special.values()], np.int32), np.ones(len(self.special), np.int64)
        for text in self.special:
            self.number[text]

    def split(self, text: str) -> list[str]:
        """Pre-tokens and special strings of a text, in order."""
        find = (PRE_TOKENS if self.beyond.search(text) else self.latin).findall
        if not any(s in text for s in self.special):
            return find(text)
        return list(chain.from_iterable([p] if k % 2 else find(p) for k, p in enumerate(self.cut.split(text))))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where there is no merge."""
        wanted = left.astype(np.int64) * self.n_ids + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.rank_of[at], -1)

    def encode(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of one block, and how many each text has; a null text has none."""
        if len(self.number) > REMEMBERED:
            self.forget()
        number = self.number.__getitem__
        cut = [np.fromiter(map(number, self.split(text or "")), np.int64) for text in texts]
        new = list(self.number)[len(self.sizes) :]
        if new:
            ids, sizes = self.merge(new)
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        starts = np.cumsum(self.sizes) - self.sizes
        parts = np.concatenate(cut) if cut else np.zeros(0, np.int64)
        sizes = self.sizes[parts]
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, cut)])]
        return gather(self.ids, starts[parts], sizes), np.diff(upto)

    def merge(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these pre-tokens, merged together over one pair occurrence index; and how many each has."""
        raw = [part.encode() for part in parts]
        ends = np.cumsum([len(r) + 1 for r in raw])  # behind each pre-token stands a -1
        symbols = np.full(ends[-1] + 1, -1, np.int64)
        inside = np.ones(len(symbols), bool)
        inside[ends - 1] = inside[-1] = False
        symbols[inside] = self.first[np.frombuffer(b"".join(raw), np.uint8)]
        after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def post(at: np.ndarray, ranks: np.ndarray) -> None:
            """Adds these places to the lists of the pairs of these ranks."""
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for rank, run in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(active, rank)
                places[rank].append(run)

        post(np.arange(len(symbols) - 1), self.ranks(symbols[:-1], symbols[1:]))
        while active:
            rank = heapq.heappop(active)
            left, right, made = self.merges[rank]
            runs = places.pop(rank)
            at = np.concatenate(runs) if len(runs) > 1 else runs[0]
            at = at[(symbols[at] == left) & (symbols[after[at]] == right)]
            if left == right and len(at):
                at = _apart(np.sort(at), after)
            if not len(at):
                continue
            gone = after[at]
            end = after[gone]
            symbols[at], symbols[gone] = made, -2
            after[at], before[end] = end, at
            ahead = before[at]
            lone = symbols[ahead] != made  # else the pair is posted by the place before
            post(at, self.ranks(symbols[at], symbols[end]))
            post(ahead[lone], self.ranks(symbols[ahead[lone]], symbols[at[lone]]))
        kept = np.concatenate([[0], np.cumsum(symbols >= 0)])[ends]
        return symbols[symbols >= 0].astype(np.int32), np.diff(kept, prepend=0)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """A text of the next `size` ids for each size. Unknown ids are skipped, bytes that are no UTF-8 replaced."""
        known = np.where((ids >= 0) & (ids < self.n_ids), ids, 0)
        lengths = np.where(known == ids, self.spelled[known], 0)
        raw = gather(self.spelling, self.spell_at[known], lengths).tobytes()
        cuts = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of ascending places of a pair of equal symbols, those that do not overlap, from the left."""
    kept, taken = [], -1
    for place, following in zip(at.tolist(), after[at].tolist()):
        if place != taken:
            kept.append(place)
            taken = following
    return np.array(kept, at.dtype)


def blocks(texts: Iterable[str | None], most: int = BLOCK_CHARS) -> Iterator[list[str | None]]:
    """Runs of whole texts of about `most` characters; a longer text is a block of its own."""
    block, chars = [], 0
    for text in texts:
        block.append(text)
        chars += len(text or "")
        if chars >= most:
            yield block
            block, chars = [], 0
    if block:
        yield block


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) for each row: the ids of the whole text, special strings as their own id.

    A null or empty text has no ids. Repeated rows and null ids stay, and other columns are not looked at.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            done = 0
            for block in blocks(t.as_py() for t in batch.column("text")):
                ids, sizes = codec.encode(block)
                cuts = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                keys = batch.column("doc_id").slice(done, len(block))
                done += len(block)
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(cuts, pa.array(ids))], names=["doc_id", "ids"])

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded): the text that the ids stand for. No ids, or null, give an empty text."""
    rows = pick(encoded, doc_id=doc_id, ids=ids)
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            listed = batch.column("ids")
            sizes = listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = listed.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            done = 0
            while done < len(sizes):  # at least a text, at most about a block of ids
                upto = max(done + 1, int(np.searchsorted(cuts, cuts[done] + BLOCK_CHARS // 4, side="right")) - 1)
                texts = codec.decode(flat[cuts[done] : cuts[upto]], sizes[done:upto])
                columns = [c.slice(done, upto - done) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=schema.names)
                done = upto

    return rows.mapInArrow(run, schema)


def encode_checked(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, exact) for each row: the ids as of `encode`, and whether decoding them gives the text again."""
    rows = pick(docs, doc_id=doc_id, text=text)
    ids_type = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", ids_type), T.StructField("exact", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            done = 0
            for block in blocks(t.as_py() for t in batch.column("text")):
                ids, sizes = codec.encode(block)
                cuts = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                exact = pa.array([(a or "") == b for a, b in zip(block, codec.decode(ids, sizes))])
                keys = batch.column("doc_id").slice(done, len(block))
                done += len(block)
                listed = pa.ListArray.from_arrays(cuts, pa.array(ids))
                yield pa.RecordBatch.from_arrays([keys, listed, exact], names=schema.names)

    return rows.mapInArrow(run, schema)


def digests(coded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids, decoded)."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
