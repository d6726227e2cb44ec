"""Token ids in plane-shuffled, compressed blocks with an index.

Documents are sorted by id, encoded, and their ids cut into blocks of a fixed number of ids. A block is
transposed into planes (all lowest bytes, then all second bytes, ...; or bit by bit), and each plane is compressed
by itself with zstandard. Planes that are zero throughout are not stored.

A folder holds two Parquet tables. `blocks` has one row for each block: which part of the order it is of and its number
there, the position of its first id within the part, its documents with their offsets (negative for one that
began in an earlier block) and lengths, the planes, and a checksum. `index` has the
position of every block's first id in the whole order, its documents and the bytes of its planes, so that a
range of ids is found without reading planes. Parquet is only the container that any Spark store can hold.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, count, islice
from types import ModuleType

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from silverlane.llm.bpe import blocks, gather
from silverlane.llm.store import pick

#: Ids of a block, and bits of a plane (1 or 8).
BLOCK = 16_384
PLANE_BITS = 8
LEVEL = 3
#: A task forgets the parts of texts it has met beyond so many characters of them; so many are asked for at once.
REMEMBERED_CHARS = 4_000_000
TOGETHER = 500


#: Characters that stay the same, or become their lower case, whatever stands beside them, and that are no white space.
PLAIN = "!-~\xa1-\u012f\u0131-\u024f"
WHITE = " \t\n\r\f\v"


def pre_token_pattern(spec: dict) -> re.Pattern | None:
    """The pattern of the pre-tokens of PLAIN texts in lower case, for files that drop white space and lower letters; else none.

    Unicode properties are written out as ranges, which `re` is faster with.
    """
    steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    split, *others = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    rules = split.get("behavior"), split.get("invert"), [(o.get("type"), o.get("use_regex"), o.get("add_prefix_space")) for o in others]
    if steps != ["NFC", "Replace", "Lowercase"] or rules != ("Removed", True, [("ByteLevel", False, False)]):
        return None
    if not spec["model"].get("end_of_word_suffix"):
        return None
    pattern = split["pattern"]["Regex"]
    every = "".join(map(chr, range(0x250)))
    for kind in (r"\p{L}", r"\p{N}"):
        runs = regex.findall(f"{kind}+", every)
        pattern = pattern.replace(kind, "".join(f"{re.escape(run[0])}-{re.escape(run[-1])}" for run in runs))
    return None if r"\p" in pattern else re.compile(pattern)


class Encoder:
    """A file of the tokenizers library, with the ids of the parts of texts that were met before.

    Where the file's pre-tokens are known before the library is asked, it is asked once for each, many at a
    time: the end-of-word mark of the last token of each says which ids are whose. Words with other characters or
    special strings go to the library as they are, and so do whole texts if the file is of another kind.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        found = pre_token_pattern(spec)
        self.find = found and found.findall
        if found:
            suffix, vocab = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
            special = "|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)"
            self.odd = re.compile(f"[^{WHITE}{PLAIN}]|{special}")
            bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            #: How the library is to take whole texts, and pre-tokens between blanks.
            self.whole = self.library.normalizer, self.library.pre_tokenizer
            self.ready = normalizers.Sequence([]), pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise])
        self.forget()

    @classmethod
    def kept(cls, path: str) -> Encoder:
        """The encoder of this file that the Python worker has from an earlier task, or a new one."""
        held = sys.modules.setdefault("_kept_encoders", ModuleType("_kept_encoders")).__dict__
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(count().__next__)
        self.odd_words: set[str] = set()
        self.held = 0
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def parts(self, text: str) -> list[str]:
        """The parts that are encoded by themselves: pre-tokens, and odd words."""
        if not self.odd.search(text):
            return self.find(text.lower())
        cut = []
        for word in re.split(f"[{WHITE}]+", text):
            if self.odd.search(word):
                self.odd_words.add(word)
                cut.append(word)
            else:
                cut += self.find(word.lower())
        return cut

    def ask(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids the library gives, and how many for each text."""
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def ask_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts, of which pre-tokens are joined by blanks."""
        odd = np.fromiter((part in self.odd_words for part in parts), bool, len(parts))
        plain, others = ([p for p, o in zip(parts, odd.tolist()) if o is kind] for kind in (False, True))
        self.library.normalizer, self.library.pre_tokenizer = self.ready
        ids, _ = self.ask([" ".join(plain[k : k + TOGETHER]) for k in range(0, len(plain), TOGETHER)])
        self.library.normalizer, self.library.pre_tokenizer = self.whole
        sizes = np.zeros(len(parts), np.int64)
        ends = np.flatnonzero(self.last[ids]) + 1
        sizes[~odd] = np.diff(ends, prepend=0)
        odd_ids, sizes[odd] = self.ask(others)
        out = np.empty(len(ids) + len(odd_ids), np.uint32)
        whose = np.repeat(odd, sizes)
        out[~whose], out[whose] = ids, odd_ids
        return out, sizes

    def encode(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has; a null text has none."""
        if not self.find:
            return self.ask([text or "" for text in texts])
        if self.held > REMEMBERED_CHARS:
            self.forget()
        number = self.number.__getitem__
        cut = [np.fromiter(map(number, self.parts(text or "")), np.int64) for text in texts]
        new = list(islice(self.number, len(self.sizes), None))
        if new:
            ids, sizes = self.ask_parts(new)
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
            self.held += sum(map(len, new))
        parts = np.concatenate(cut) if cut else np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(self.sizes[parts])])[np.cumsum([0, *map(len, cut)])]
        return gather(self.ids, (np.cumsum(self.sizes) - self.sizes)[parts], self.sizes[parts]), np.diff(upto)


def planes_of(ids: np.ndarray, bits: int, pack: zstandard.ZstdCompressor) -> list[bytes]:
    """The compressed planes of a block, lowest first, up to the highest that is not zero."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    cut = ((ids >> low) & ((1 << bits) - 1) for low in range(0, top, bits))
    return [pack.compress((np.packbits(p.astype(np.uint8)) if bits == 1 else p.astype(np.uint8)).tobytes()) for p in cut]


def ids_of(planes: Iterable[bytes], n: int, bits: int, unpack: zstandard.ZstdDecompressor) -> np.ndarray:
    """The ids of a block from its planes."""
    ids = np.zeros(n, np.uint32)
    for k, plane in enumerate(planes):
        raw = np.frombuffer(unpack.decompress(plane), np.uint8)
        ids |= (np.unpackbits(raw, count=n) if bits == 1 else raw).astype(np.uint32) << np.uint32(k * bits)
    return ids


class Cutter:
    """Cuts a stream of documents into blocks."""

    def __init__(self, block: int, bits: int):
        self.block, self.bits, self.pack = block, bits, zstandard.ZstdCompressor(level=LEVEL)
        self.left, self.first, self.blocks = np.zeros(0, np.uint32), 0, 0
        self.keys, self.starts, self.sizes, self.end = [], [], [], 0

    def add(self, ids: np.ndarray, sizes: np.ndarray, keys: list) -> Iterator[tuple]:
        """The blocks that are full with these documents."""
        ends = self.end + np.cumsum(sizes)
        self.keys += keys
        self.starts += (ends - sizes).tolist()
        self.sizes += sizes.tolist()
        self.end = int(ends[-1]) if len(ends) else self.end
        self.left = np.concatenate([self.left, ids])
        yield from self.cut(self.block)

    def cut(self, least: int) -> Iterator[tuple]:
        """Rows of (block, first, docs, n_ids, crc, planes) while `least` ids are left."""
        done, gone = 0, 0
        while len(self.left) - done >= least:
            ids = self.left[done : done + self.block]
            upto = self.first + len(ids)
            listed = gone
            while listed < len(self.starts) and self.starts[listed] < upto:
                listed += 1
            docs = [(key, start - self.first, size) for key, start, size in zip(*(c[gone:listed] for c in (self.keys, self.starts, self.sizes)))]
            after = self.starts[listed] if listed < len(self.starts) else self.end
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            yield self.blocks, self.first, docs, len(ids), crc, planes_of(ids, self.bits, self.pack)
            gone = listed - 1 if after > upto else listed
            self.first, self.blocks, done = upto, self.blocks + 1, done + len(ids)
        self.left = self.left[done:]
        del self.keys[:gone], self.starts[:gone], self.sizes[:gone]


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    block: int = BLOCK,
    plane_bits: int = PLANE_BITS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encodes every text with the tokenizers library, adds the end id, and writes blocks and index below the path.

    Documents are in order of doc_id, null first; those that share one in order of their text, null first.
    Null and empty texts have the end id alone, repeated rows all stay, and other columns are not looked at.
    An empty table gives files without blocks.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("docs", T.ArrayType(T.StructType([rows.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in ("at", "n")]]))),
            T.StructField("n_ids", T.IntegerType()),
            T.StructField("crc", T.LongType()),
            T.StructField("planes", T.ArrayType(T.BinaryType())),
            T.StructField("plane_bits", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, part = to_arrow_schema(schema), TaskContext.get().partitionId()
        encoder, cutter = Encoder.kept(tokenizer), Cutter(block, plane_bits)

        def batch_of(found: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
            for row in found:
                values = (part, *row, plane_bits)
                values = [[dict(zip(("doc_id", "at", "n"), d)) for d in v] if f.name == "docs" else v for v, f in zip(values, arrow)]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

        for batch in batches:
            done = 0
            for texts in blocks((t.as_py() for t in batch.column("text")), 1_000_000):
                keys = batch.column("doc_id").slice(done, len(texts)).to_pylist()
                done += len(texts)
                ids, sizes = encoder.encode(texts)
                yield from batch_of(cutter.add(np.insert(ids, np.cumsum(sizes), end_id), sizes + 1, keys))
        yield from batch_of(cutter.cut(1))

    # The texts' beginnings are in the ranges too, or a doc_id of many rows would be one task's work.
    dealt = rows.withColumn("begins", F.substring("text", 1, 64)).repartitionByRange("doc_id", "begins")
    ordered = dealt.sortWithinPartitions("doc_id", "text").select("doc_id", "text")
    ordered.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    spark = docs.sparkSession
    held = spark.read.schema(schema).parquet(f"{path}/blocks")
    parts = held.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each task that wrote
    offsets = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    held.join(F.broadcast(offsets), "part").select(
        "part",
        "block",
        (F.col("offset") + F.col("first")).alias("start"),
        "offset",
        "n_ids",
        F.size("docs").alias("n_docs"),
        F.get("docs.doc_id", F.lit(0)).alias("first_doc"),
        F.element_at("docs.doc_id", -1).alias("last_doc"),
        F.transform("planes", F.octet_length).alias("plane_bytes"),
    ).write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, start, offset, n_ids, n_docs, first_doc, last_doc, plane_bytes) of all blocks."""
    return spark.read.parquet(f"{path}/index")


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    """The rows of blocks with the position of their part in the whole order; a part is one row of what is broadcast."""
    offsets = read_index(spark, path).groupBy("part").agg(F.first("offset").alias("offset"))
    return spark.read.parquet(f"{path}/blocks").join(F.broadcast(offsets), "part")


def _checked(row: dict, unpack: zstandard.ZstdDecompressor) -> np.ndarray:
    ids = ids_of(row["planes"], row["n_ids"], row["plane_bits"], unpack).astype("<u4")
    if zlib.crc32(ids.tobytes()) != row["crc"]:
        raise ValueError(f"block {row['block']} of part {row['part']} does not match its checksum")
    return ids


def _times(a: int, b: int) -> int:
    """Product of two polynomials over two elements modulo that of CRC-32, the lowest power in the highest bit."""
    out = 0
    while a:
        if a & 1 << 31:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def crc_before(crc: int, n_bytes: int) -> int:
    """What a piece of this checksum adds to that of the whole, if so many bytes follow; the parts are combined by XOR."""
    power, square = 1 << 31, 1 << 23  # 1, and x to the 8th
    while n_bytes:
        if n_bytes & 1:
            power = _times(power, square)
        n_bytes, square = n_bytes >> 1, _times(square, square)
    return _times(power, crc)


def _pieces(spark: SparkSession, path: str, last: T.StructField, value: Callable[[bytes, int], object]) -> DataFrame:
    """(doc_id, start, n_tokens, at, whole) of what each block has of each document, and a value of its ids and the bytes behind."""
    held = _blocks(spark, path)
    doc = held.schema["docs"].dataType.elementType["doc_id"]
    longs = [T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "at")]
    schema = T.StructType([T.StructField("doc_id", doc.dataType), *longs, T.StructField("whole", T.BooleanType()), last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, unpack = to_arrow_schema(schema), zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids, first, made = _checked(row, unpack), row["offset"] + row["first"], []
                for doc in row["docs"]:
                    at, end = doc["at"], doc["at"] + doc["n"]
                    piece = ids[max(0, at) : end].tobytes()
                    whole = at >= 0 and end <= len(ids)
                    made.append((doc["doc_id"], first + at, doc["n"], max(0, -at), whole, value(piece, max(0, end - len(ids)) * 4)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)

    needed = held.select("part", "block", "offset", "first", "docs", "n_ids", "crc", "planes", "plane_bits")
    return needed.mapInArrow(run, schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, ids as 4 bytes each, lowest first.

    `start` is the number of ids of all documents before it. Only documents that lie in several blocks are shuffled.
    """
    pieces = _pieces(spark, path, T.StructField("ids", T.BinaryType()), lambda piece, behind: piece)
    names = ["doc_id", "start", "n_tokens", "ids"]
    joined = pieces.where(~F.col("whole")).groupBy("start", "doc_id", "n_tokens")
    joined = joined.agg(F.expr("listagg(ids) WITHIN GROUP (ORDER BY at)").alias("ids"))
    return pieces.where("whole").select(names).union(joined.select(names))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document: the checksum of its ids as read back.

    Only checksums of pieces are shuffled.
    """
    pieces = _pieces(spark, path, T.StructField("crc", T.LongType()), lambda piece, behind: crc_before(zlib.crc32(piece), behind))
    return pieces.groupBy("start", "doc_id", "n_tokens").agg(F.bit_xor("crc").alias("ids_crc32")).select("doc_id", "start", "n_tokens", "ids_crc32")


def read_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """(start, ids) of the ids from position `first` up to, not including, `last`, by block.

    The index names the blocks; of the other parts no planes are read.
    """
    wanted = read_index(spark, path).where((F.col("start") < last) & (F.col("start") + F.col("n_ids") > first))
    low, high = wanted.agg(F.min("part"), F.max("part")).first()
    held = _blocks(spark, path).where(F.col("part").between(low, high))
    start = F.col("offset") + F.col("first")
    held = held.where((start < last) & (start + F.col("n_ids") > first))
    schema = "start long, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                begins = row["offset"] + row["first"]
                ids = _checked(row, unpack)[max(0, first - begins) : max(0, last - begins)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([max(first, begins)], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))],
                    names=["start", "ids"],
                )

    return held.select("part", "block", "offset", "first", "n_ids", "crc", "planes", "plane_bits").mapInArrow(run, schema)

