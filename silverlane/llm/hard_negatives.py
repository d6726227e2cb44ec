"""Hard negatives by exact inner products, scored with the method of the Four Russians.

Components become integers. The candidates are stored as packs: of every bit of the integers a plane, eight
dimensions to a byte. For an anchor the sums of all 256 subsets of each eight of its components are laid out in a
table, so a byte of a candidate's plane looks up what eight dimensions add at that bit. The planes are gone
through from the sign down, doubling what was added so far: shifts and additions give the full inner product.

Anchors are a stated share of the rows and meet all of them, one bounded block of anchors after the other: a block is
broadcast, the packs stay where they are, and a task sends on no more than the best few rows of each anchor. There are two
passes, as what counts as a hard negative is known only when the positives are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverlane.llm.store import pick, stored

#: Anchors that are broadcast at a time: at most so many, and at most so many components.
ANCHORS = 16_384
COMPONENTS = 2_000_000
#: Candidates of a pack, and anchors whose tables are laid out together.
PACK = 4_096
TOGETHER = 32
#: The integer of a component is floor(SCALE * x).
SCALE = 256
LONGEST = 2.0**63

PACKS = "n long, packed long, ids binary, labels binary, n_planes int, planes binary"
SCORED = "anchor_id long, least long, id long, score long"


def finite(vector: str) -> Column:
    """Not null, and without null or non-finite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~odd


def bit_planes(values: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of planes, and the bytes of (plane, eight dimensions, row); the highest plane is the sign."""
    rows, n = values.shape
    top = max(int(values.max(initial=0)), ~int(values.min(initial=0)), 0).bit_length()
    wide = np.zeros((rows, -(-n // 8) * 8), np.int64)
    wide[:, :n] = values
    planes = [np.packbits(((wide >> bit) & 1).astype(np.uint8), axis=1, bitorder="little").T for bit in range(top + 1)]
    return top + 1, np.ascontiguousarray(planes)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(eight dimensions, 256, anchor): the sum of each subset of eight components."""
    m, n = anchors.shape
    wide = np.zeros((m, -(-n // 8) * 8), np.int64)
    wide[:, :n] = anchors
    eights = wide.reshape(m, wide.shape[1] // 8, 8)
    sums = np.zeros((eights.shape[1], 256, m), np.int64)
    for bit in range(8):
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + eights[:, :, bit].T[:, None, :]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(row, anchor): the inner products, exact wherever they fit 64 bits."""
    n_planes, eights, rows = planes.shape
    least = int(np.abs(sums).max(initial=0)) * max(eights, 1) << n_planes
    kind = np.int32 if least < 2**31 else np.int64
    sums = sums.astype(kind)
    total = np.zeros((rows, sums.shape[2]), kind)
    for plane in range(n_planes - 1, -1, -1):
        added = np.zeros_like(total)
        for eight in range(eights):
            added += sums[eight].take(planes[plane, eight], axis=0)
        total = -added if plane == n_planes - 1 else (total << 1) + added
    return total.astype(np.int64)


class Best:
    """For each asked (anchor, limits) the best few rows seen: highest score first, ties to the smaller id."""

    def __init__(self, keep: int):
        self.keep = keep
        self.rows: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, key: tuple, score: np.ndarray, ids: np.ndarray) -> None:
        held = self.rows.get(key)
        if held is not None:
            if len(held[0]) == self.keep:
                near = score >= held[0][-1]
                score, ids = score[near], ids[near]
            if not len(score):
                return
            score, ids = np.concatenate([held[0], score]), np.concatenate([held[1], ids])
        if len(score) > 8 * self.keep:  # the k-th best score bounds what has to be sorted
            near = score >= np.partition(score, len(score) - self.keep)[len(score) - self.keep]
            score, ids = score[near], ids[near]
        order = np.lexsort((ids, -score))[: self.keep]
        self.rows[key] = score[order], ids[order]

    def batches(self) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SCORED.split(", ")]
        held = [(*key, s, i) for key, (s, i) in self.rows.items()]
        for k in range(0, len(held), 5_000):
            some = held[k : k + 5_000]
            sizes = [len(s) for _, _, s, _ in some]
            columns = (
                np.repeat([a for a, _, _, _ in some], sizes),
                np.repeat([x for _, x, _, _ in some], sizes),
                np.concatenate([i for _, _, _, i in some]),
                np.concatenate([s for _, _, s, _ in some]),
            )
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def vectors_of(rows: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(id, label, vector): one row of integer components for each usable id, the least of those that share it."""
    usable = pick(rows, id=vec_id, label=label, vector=embedding).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & finite("vector")
    )
    whole = F.transform("vector", lambda x: F.floor(SCALE * x.cast("double")))
    within = F.forall("vector", lambda x: F.abs(SCALE * x.cast("double")) < LONGEST)
    one = usable.where(within).select(F.col("id").cast("long"), F.col("label").cast("long"), whole.alias("vector"))
    return one.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")


def packs(vectors: DataFrame, size: int = PACK) -> DataFrame:
    """The packs of bit-planes of these vectors; rows of one pack have vectors of one length, and ids in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("vector").value_lengths().to_numpy()
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                for k in range(0, len(at), size):
                    some = batch.take(pa.array(at[k : k + size]))
                    ids, labels = np.array(some.column("id")), np.array(some.column("label"))
                    order = np.argsort(ids)
                    values = np.array(some.column("vector").flatten()).reshape(len(ids), n)[order]
                    n_planes, planes = bit_planes(values.astype(np.int64))
                    row = (n, len(ids), ids[order].tobytes(), labels[order].tobytes(), n_planes, planes.tobytes())
                    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
                    names = [f.split()[0] for f in PACKS.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)

    return vectors.select("id", "label", "vector").mapInArrow(run, PACKS)


def unpack(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length of the vectors, ids, labels, planes) of each pack."""
    for k in range(batch.num_rows):
        row = batch.slice(k, 1).to_pylist()[0]
        shape = row["n_planes"], -(-row["n"] // 8), row["packed"]
        planes = np.frombuffer(row["planes"], np.uint8).reshape(shape)
        yield row["n"], np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), planes


def block_of(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and integer vectors of a bounded block of anchors, of one length."""
    table = rows.select("id", "label", "vector").toArrow()
    ids, labels = np.array(table.column("id")), np.array(table.column("label"))
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return ids, labels, flat.astype(np.int64).reshape(len(ids), len(flat) // max(len(ids), 1))


def scored(vectors: np.ndarray, n: int, planes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each anchor's place and its scores of all rows of a pack of vectors of length n."""
    if n != vectors.shape[1]:
        return
    for k in range(0, len(vectors), TOGETHER):
        found = np.ascontiguousarray(scores(subset_sums(vectors[k : k + TOGETHER]), planes).T)
        yield from enumerate(found, k)


def _first(scored: DataFrame, keep: int, *by: str) -> DataFrame:
    """The best rows of each group of those that the tasks found, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _blocks(vectors: DataFrame, most: int) -> Iterator[DataFrame]:
    """The anchors in blocks of at most about `most` rows and COMPONENTS components, of one length each."""
    for n, count in sorted((r["n"], r["count"]) for r in vectors.groupBy("n").count().collect()):
        blocks = -(-count // max(1, min(most, COMPONENTS // max(n, 1))))
        for k in range(blocks):
            yield vectors.where((F.col("n") == n) & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == k))


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    relabel: Column | None = None,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    anchors: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor is a row for which `anchor`, a condition on its id, holds. Its positives are the `positives` best
    other rows of its label; for each, the `negatives` best rows of other labels are returned whose score is
    from `low` to `high` percent of the positive's. Scores are inner products of floor(256 x) of the components
    x as doubles, higher first, ties to the smaller id.

    Rows with a null id, label or vector, with null or non-finite components, or with one too large for a
    64-bit integer take no part; scores beyond 64 bits are not detected. Rows that share an id count as one, the
    least label and vector. An anchor meets the rows whose vector has its length, which may be 0. `relabel`
    is an expression over the id and label columns for the label to use. An anchor without positives, or a
    positive without such negatives, gives no rows; an empty table gives none. Other columns are not looked at.
    """
    columns = {c: rows.schema[c].dataType for c in (vec_id, label)}
    if relabel is not None:
        chosen = pick(rows, **{vec_id: vec_id, label: label, embedding: embedding})
        rows = chosen.withColumn(label, F.when(F.col(label).isNotNull(), relabel).cast(columns[label]))
    vectors = stored(vectors_of(rows, vec_id, embedding, label), "vectors")
    held = stored(packs(vectors), "packs")
    of_id = vectors.withColumn(vec_id, F.col("id")).where(anchor)
    asked = stored(of_id.select("id", "label", "vector", F.size("vector").alias("n")), "anchors")
    spark, parts = rows.sparkSession, []
    for block in _blocks(asked, anchors):
        some = spark.sparkContext.broadcast(block_of(block))
        best = stored(_first(_positives(held, some, positives), positives, "anchor_id"), "positives")
        limits = best.select("anchor_id", "score").distinct().toArrow()  # at most `positives` for each anchor of the block
        wanted = spark.sparkContext.broadcast(_by_anchor(limits))
        found = _first(_negatives(held, some, wanted, negatives, low, high), negatives, "anchor_id", "least")
        hard = found.select("anchor_id", F.col("least").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        pairs = best.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        parts.append(stored(pairs.join(hard, ["anchor_id", "positive_score"]), "negatives"))
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    return every.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _by_anchor(limits: pa.Table) -> dict[int, list[int]]:
    found: dict[int, list[int]] = {}
    for anchor, score in zip(limits.column("anchor_id").to_pylist(), limits.column("score").to_pylist()):
        found.setdefault(anchor, []).append(score)
    return found


def _positives(held: DataFrame, some, keep: int) -> DataFrame:
    """The best rows of the same label that each task has for each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (own_ids, own_labels, vectors), best = some.value, Best(keep)
        for batch in batches:
            for n, ids, labels, planes in unpack(batch):
                same = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
                for k, score in scored(vectors, n, planes):
                    own = int(own_ids[k])
                    at = same.get(int(own_labels[k]))
                    if at is not None:
                        at = at[ids[at] != own]
                        best.add((own, 0), score[at], ids[at])
        yield from best.batches()

    return held.mapInArrow(run, SCORED)


def _negatives(held: DataFrame, some, wanted, keep: int, low: int, high: int) -> DataFrame:
    """The best rows of other labels within the limits that each task has for each anchor and positive score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (own_ids, own_labels, vectors), limits, best = some.value, wanted.value, Best(keep)
        for batch in batches:
            for n, ids, labels, planes in unpack(batch):
                for k, score in scored(vectors, n, planes):
                    own = int(own_ids[k])
                    for positive in limits.get(own, ()):
                        least, most = -(-low * positive // 100), high * positive // 100
                        at = np.flatnonzero((score >= least) & (score <= most) & (labels != own_labels[k]))
                        if len(at):
                            best.add((own, positive), score[at], ids[at])
        yield from best.batches()

    return held.mapInArrow(run, SCORED)


#: The hard negatives of the registered query, in SQL.
SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 3
"""
