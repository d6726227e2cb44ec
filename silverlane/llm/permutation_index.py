"""Approximate nearest neighbours with a permutation index.

Every vector is represented by its nearest pivots in order of distance, and is posted in the inverted file
of each of them. A query visits the files of its own nearest pivots only. What it finds there is ranked by how
far its order is from the query's (Spearman's footrule, where a pivot that is not among the nearest counts
as the first place behind them), and the vectors of least footrule are ranked again by exact distance.

The index is dealt by vector into blocks of bounded size, each with its own inverted files. A vector is shuffled
once; queries are streamed through the blocks, of which each is held by one task at a time. Copies of a vector
are one entry, which keeps as many of the smallest ids as a result can need, so a vector that is there a
million times is no larger than another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverlane.llm.store import pick, stored

#: Pivots, taken from the vectors by hash (all, if there are fewer), how many represent a vector, and
#: in the files of how many of its own a query looks.
PIVOTS = 1024
NEAREST = 64
FILES = 16
#: Share of the vectors visited that is ranked by exact distance, at least so many, and all up to this share of the greatest footrule.
RANKED_SHARE = 0.3
RANKED_LEAST = 500
RANKED_FOOTRULE = 0.5
#: Vectors of a block.
BLOCK = 16_384


def usable(vector: str) -> Column:
    """Not null, not empty, with finite components that are not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row of a the squared distance to each row of b; good enough to order pivots."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)


def orders(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first; ties to the pivot that comes first."""
    nearest = min(nearest, len(pivots))
    out = np.empty((len(vectors), nearest), np.int16)
    for k in range(0, len(vectors), 4096):
        far = squared_distances(vectors[k : k + 4096], pivots)
        some = np.sort(np.argpartition(far, nearest - 1, axis=1)[:, :nearest], axis=1)
        sorted_ = np.argsort(np.take_along_axis(far, some, axis=1), axis=1, kind="stable")
        out[k : k + 4096] = np.take_along_axis(some, sorted_, axis=1)
    return out


class InvertedFiles:
    """For each pivot the vectors of a block that have it among their nearest."""

    def __init__(self, orders: np.ndarray, n_pivots: int):
        self.orders = orders
        self.n, self.width = orders.shape
        self.n_pivots = n_pivots
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.posted = (by_pivot // self.width).astype(np.int32)
        self.starts = np.searchsorted(flat[by_pivot], np.arange(n_pivots + 1))

    def visit(self, order: np.ndarray, files: int, least: int) -> np.ndarray:
        """The vectors in the files of a query's nearest pivots: the first `files`, and more if there are not `least` in them."""
        seen = np.zeros(self.n, bool)
        for at, pivot in enumerate(order.tolist()):
            if at >= files and np.count_nonzero(seen) >= least:
                break
            seen[self.posted[self.starts[pivot] : self.starts[pivot + 1]]] = True
        else:
            if np.count_nonzero(seen) < least:
                seen[:] = True
        return np.flatnonzero(seen)

    def footrule(self, order: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The footrule distance of these vectors to a query of this order, as a share of the greatest there is."""
        place = np.full(self.n_pivots, self.width, np.int32)
        place[order] = np.arange(self.width)
        own = place[self.orders[at]]
        of_theirs = np.abs(own - np.arange(self.width)).sum(axis=1)
        of_query_alone = self.width * (self.width + 1) // 2 - (self.width - own).sum(axis=1)
        return (of_theirs + of_query_alone) / (self.width * (self.width + 1))


def matrix(column: pa.ChunkedArray | pa.Array, dtype: type) -> np.ndarray:
    """A column of lists of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


class Block:
    """The vectors of a block with their inverted files."""

    def __init__(self, rows: pa.Table, n_pivots: int):
        self.vectors = matrix(rows.column("vector"), np.float64)
        self.ids = rows.column("ids").combine_chunks()
        self.least_id = pc.list_element(self.ids, 0).to_numpy(zero_copy_only=False)
        self.files = InvertedFiles(matrix(rows.column("order"), np.int64), n_pivots)

    def answers(
        self, asked: pa.RecordBatch, k: int, files: int, ranked_share: float, ranked_least: int, ranked_footrule: float
    ) -> pa.RecordBatch:
        """(vector, ids, score): the `k` nearest found for each query."""
        rows, hits, scores = [], [], []
        queries = zip(matrix(asked.column("vector"), np.float64), matrix(asked.column("order"), np.int64))
        for row, (vector, order) in enumerate(queries):
            near = self.files.visit(order, files, ranked_least)
            far = self.files.footrule(order, near)
            most = max(ranked_least, int(len(near) * ranked_share), np.count_nonzero(far <= ranked_footrule))
            if most < len(near):
                near = near[np.argpartition(far, most - 1)[:most]]
            exact = np.sqrt(((self.vectors[near] - vector) ** 2).sum(axis=1))
            best = np.lexsort((self.least_id[near], exact))[:k]
            rows.append(np.full(len(best), row))
            hits.append(near[best])
            scores.append(exact[best])
        columns = [
            asked.column("vector").take(pa.array(np.concatenate(rows))),
            self.ids.take(pa.array(np.concatenate(hits))),
            pa.array(np.concatenate(scores)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["vector", "ids", "score"])


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(vector, ids): each vector once, with its `keep` smallest ids in order."""
    ranked = rows.distinct().withColumn("k", F.row_number().over(Window.partitionBy("vector").orderBy("id")))
    kept = ranked.where(F.col("k") <= keep)  # Spark limits each group before the shuffle too
    return kept.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    pivots: int = PIVOTS,
    nearest: int = NEAREST,
    ranked_share: float = RANKED_SHARE,
    ranked_least: int = RANKED_LEAST,
    block: int = BLOCK,
    files: int = FILES,
    ranked_footrule: float = RANKED_FOOTRULE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the `k` nearest vectors found for each query, other than itself.

    The score is the Euclidean distance, ties go to the smaller id, and all candidates are given if there are
    fewer than `k`. Vectors that are null, empty, zero, or have null or non-finite components take no part, nor
    do rows without id; a query is compared with vectors of its own length. Of repeated rows one counts.
    Other columns are not looked at.
    """
    rows, asked = (
        pick(df, id=vec_id, vector=embedding)
        .where(F.col("id").isNotNull() & usable("vector"))
        .select("id", F.col("vector").cast("array<double>").alias("vector"))
        for df in (vectors, queries)
    )
    entries = stored(distinct_vectors(rows, k + 1).withColumn("n", F.size("vector")), "vectors")
    sizes = {r["n"]: r["count"] for r in entries.groupBy("n").count().collect()}  # one row for each length
    first: dict[int, np.ndarray] = {}
    for n in sizes:
        some = entries.where(F.col("n") == n).orderBy(F.xxhash64("vector"), "vector").limit(pivots)
        first[n] = matrix(some.select("vector").toArrow().column("vector"), np.float64)
    id_type = rows.schema["id"].dataType.simpleString()
    blocks = F.lit(0)
    for n, count in sizes.items():
        blocks = F.when(F.col("n") == n, -(-count // block)).otherwise(blocks)

    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array(batch.column("n"))
            out = [None] * len(lengths)
            for n in set(lengths.tolist()):
                at = np.flatnonzero(lengths == n)
                made = orders(matrix(batch.column("vector").take(pa.array(at)), np.float64), first[n], nearest)
                for place, order in zip(at.tolist(), made):
                    out[place] = order
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int16()))], names=[*batch.schema.names, "order"])

    def represented(df: DataFrame) -> DataFrame:
        return df.mapInArrow(represent, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", order array<smallint>")

    asked_once = stored(asked.select("vector").distinct().withColumn("n", F.size("vector")), "queries")
    held = [F.col(c) for c in ("n", "block", "asks", "vector", "ids", "order")]
    posted = represented(entries).withColumns({"block": F.pmod(F.xxhash64("vector"), blocks), "asks": F.lit(False)}).select(*held)
    sent = (
        represented(asked_once.where(blocks > 0))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)))
        .withColumns({"asks": F.lit(True), "ids": F.lit(None).cast(f"array<{id_type}>")})
        .select(*held)
    )
    found_kinds = f"vector array<double>, ids array<{id_type}>, score double"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks one after the other, of each first the vectors and then the queries, which are answered as they come."""
        block_now, parts, searched = None, [], None
        for batch in batches:
            n, dealt, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "block", "asks"))
            cuts = np.flatnonzero((np.diff(n) != 0) | (np.diff(dealt) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            ends = [0, *cuts.tolist(), len(n)] if len(n) else []
            for low, high in zip(ends, ends[1:]):
                piece, at = batch.slice(low, high - low), (n[low], dealt[low])
                if at != block_now:
                    block_now, parts, searched = at, [], None
                if not asks[low]:
                    parts.append(piece)
                elif parts:
                    if searched is None:
                        searched = Block(pa.Table.from_batches(parts), pivots)
                    yield searched.answers(piece, k + 1, files, ranked_share, ranked_least, ranked_footrule)

    found = (
        posted.union(sent)
        .repartition("n", "block")
        .sortWithinPartitions("n", "block", "asks")
        .mapInArrow(find, found_kinds)
        .select("vector", "score", F.explode("ids").alias("id"))
    )
    ranked = found.withColumn("k", F.row_number().over(Window.partitionBy("vector").orderBy("score", "id")))
    lists = (
        ranked.where(F.col("k") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("near"))  # k + 1 at most
    )
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (
        asked.select(F.col("id").alias("query_id"), "vector")
        .distinct()
        .join(lists, "vector")
        .select("query_id", F.posexplode(others).alias("at", "found"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("found.id").alias("vec_id"), F.col("found.score").alias("score"))
    )
