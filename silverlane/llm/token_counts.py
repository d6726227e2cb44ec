"""Token counts of a sentencepiece BPE model without materialising ids.

No piece of the model reaches over certain places of a text, so a text falls into pre-tokens whose
numbers of pieces simply add up. Pieces are counted once per distinct pre-token; a document's count
is the sum over its pre-tokens of frequency times pieces.

Frequent pre-tokens hold most of all (document, pre-token) rows. A bounded number of them goes to
all tasks as a lookup table and is summed where the document is read; only rows of rare ones are
shuffled and joined, so no key of the join is hot.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.llm.store import pick, stored

#: Sentencepiece writes a space as this character; in a text it counts as a space.
SPACE = "▁"
#: Stands before a pre-token when its pieces are counted; no piece contains it.
ANCHOR = "\n"
#: Distinct pre-tokens a task holds before it hands them on.
HELD = 50_000
#: So many frequent pre-tokens at most, each of so many characters at most, are sent to all tasks.
FREQUENT = 131_072
FREQUENT_CHARS = 64


def load(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def pre_token_pattern(model: str) -> re.Pattern:
    """How the model's vocabulary lets a text be split.

    Two characters can be joined only if they stand side by side in some piece. The largest group of
    characters connected that way (letters, in the usual models) is kept apart from all others, and
    a space stays with what follows it, which needs that no piece has a space after another character.
    """
    processor = load(model)
    pieces = [
        processor.id_to_piece(i)
        for i in range(processor.get_piece_size())
        if not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i))
    ]
    group: dict[str, str] = {}

    def root(char: str) -> str:
        while group.setdefault(char, char) != char:
            char = group[char]
        return char

    for piece in pieces:
        body = piece.lstrip(SPACE)
        if SPACE in body or ANCHOR in body:
            raise ValueError(f"the model joins over a space or a line end: {piece!r}")
        for a, b in zip(body, body[1:]):
            group[root(a)] = root(b)
    members: dict[str, list[str]] = {}
    for char in sorted(group):
        members.setdefault(root(char), []).append(char)
    largest = max(members.values(), key=len, default=["a"])
    letters = "".join(map(re.escape, largest))
    return re.compile(f"[ {SPACE}]*(?:[{letters}]+|[^{letters} {SPACE}]+)|[ {SPACE}]+")


def split(pattern: re.Pattern, text: str | None) -> list[str]:
    """Pre-tokens of a text, which sentencepiece begins with a space unless it is empty."""
    return pattern.findall(" " + text) if text else []


def distinct_pre_tokens(texts: DataFrame, model: str) -> DataFrame:
    """(token, n): how often each pre-token occurs in all texts."""
    pattern = pre_token_pattern(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"token": list(seen), "n": pa.array(seen.values(), pa.int64())})
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                seen.update(split(pattern, text.as_py()))
                if len(seen) >= HELD:
                    yield flush()
        if seen:
            yield flush()

    return texts.mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def with_pieces(tokens: DataFrame, model: str) -> DataFrame:
    """Adds `pieces`, counted once for each row of (token, n)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = load(model)
        before = len(processor.encode(ANCHOR))
        for batch in batches:
            made = processor.encode([ANCHOR + t for t in batch.column(0).to_pylist()], num_threads=1)
            pieces = pa.array([len(ids) - before for ids in made], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pieces], names=["token", "n", "pieces"])

    return tokens.mapInArrow(encode, "token string, n long, pieces long")


def frequent_tokens(counted: DataFrame, most: int = FREQUENT) -> dict[str, int]:
    """Pieces of the most frequent short pre-tokens: at most `most`, so bounded for any corpus."""
    step = F.floor(F.log2("n") * 8)
    short = counted.where(F.length("token") <= FREQUENT_CHARS)
    steps = short.groupBy(step.alias("step")).count().collect()  # eight rows per power of two
    cut, total = None, 0
    for row in sorted(steps, reverse=True):
        total += row["count"]
        if total > most:
            break
        cut = row["step"]
    if cut is None:
        return {}
    rows = short.where(step >= cut).select("token", "pieces").toArrow()
    return dict(zip(rows.column("token").to_pylist(), rows.column("pieces").to_pylist()))


def count_tokens(
    docs: DataFrame, model: str, over: int = 4096, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of `docs`, without begin or end tokens.

    A null or empty text has no bytes and no tokens. Rows are counted one by one, so repeated rows and
    null ids stay. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=doc_id, text=text)
    counted = stored(with_pieces(distinct_pre_tokens(rows.select("text"), model), model), "pre-tokens")
    known = spark.sparkContext.broadcast(frequent_tokens(counted, frequent))
    pattern = pre_token_pattern(model)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each rare pre-token of a document, and one with what the frequent ones sum up to."""
        lookup = known.value.get
        for batch in batches:
            found = Found(batch)
            for at, text in enumerate(batch.column("text")):
                text = text.as_py() or ""
                done = 0
                for token, n in Counter(split(pattern, text)).items():
                    pieces = lookup(token)
                    if pieces is None:
                        found.add(at, token, n)
                    else:
                        done += n * pieces
                found.add(at, str(at), done, len(text.encode()))
                if len(found.at) >= HELD:
                    yield found.flush()
            yield found.flush()

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        frequencies, f"row long, token string, times long, n_bytes long, doc_id {kind}"
    )
    whole = F.col("n_bytes").isNotNull()
    pieces = F.when(whole, F.col("times")).otherwise(F.col("times") * F.col("pieces"))
    return (
        found.join(counted.select("token", "pieces"), "token", "left")
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(pieces).alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit"))
    )


class Found:
    """Rows of `frequencies` on their way out; n_bytes and doc_id are only on a document's own row."""

    def __init__(self, batch: pa.RecordBatch):
        self.rows, self.ids = batch.column("row"), batch.column("doc_id")
        self.at, self.tokens, self.times, self.sizes = [], [], [], []

    def add(self, at: int, token: str, times: int, size: int | None = None) -> None:
        self.at.append(at)
        self.tokens.append(token)
        self.times.append(times)
        self.sizes.append(size)

    def flush(self) -> pa.RecordBatch:
        own = [None if size is None else at for at, size in zip(self.at, self.sizes)]
        out = pa.RecordBatch.from_arrays(
            [
                self.rows.take(pa.array(self.at, pa.int64())),
                pa.array(self.tokens, pa.string()),
                pa.array(self.times, pa.int64()),
                pa.array(self.sizes, pa.int64()),
                self.ids.take(pa.array(own, pa.int64())),
            ],
            names=["row", "token", "times", "n_bytes", "doc_id"],
        )
        self.at, self.tokens, self.times, self.sizes = [], [], [], []
        return out
