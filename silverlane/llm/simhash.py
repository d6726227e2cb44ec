"""SimHash near-duplicates: exact links between fingerprints found with vantage-point trees.

Distinct fingerprints are dealt to shards by the upper levels of a vantage-point tree. A fingerprint
has one home shard, and also visits the shards that its ball of the linking distance may overlap
(of two shards only one visits the other). The tree grows with the corpus, so shards stay of one size.
In a shard a tree of rings around vantage points finds all pairs: of points and queries only those whose
distances to the vantage point differ by no more than the linking distance go on together.
Large shards, such as one full of near copies, are cut into blocks of bounded size that meet in pairs.

A task hands on no pairs, only for each fingerprint the smallest one it is connected with there, so
a group of n near copies costs n rows and not n squared. Connected components follow by star contraction.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.llm.store import pick, stored

SEED = 42
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Fingerprints the upper tree is fitted on: so many for each shard, and the least and most of them.
LEAF = 32
SAMPLE = 16_384
MOST_SAMPLE = 4_194_304
#: Fingerprints a shard should have, and those of a block.
SHARD = 16_384
BLOCK = 32_768
#: A fingerprint is frequent if more documents than this, and more than one HOT_KEYS-th of all, have it.
HOT_ROWS = 1_000
HOT_KEYS = 10_000
#: Pairs compared at once, and points times queries below which a tree no longer pays.
AT_ONCE = 2_000_000
SMALL = 60_000


def fingerprint(text: str | None, shingle: int) -> int:
    """Bit by bit the majority over the hashes of all word shingles; zero without words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(len(words) - shingle, 0) + 1
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 65_536):
        bits = np.unpackbits(hashes[k : k + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) for each row; the 64 bits are kept as a long."""
    rows = pick(docs, doc_id=doc_id, text=text)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), shingle) for x in batch.column("text")]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps], names=["doc_id", "fp"])

    return rows.mapInArrow(run, schema)


def apart(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """Differing bits."""
    return np.bitwise_count(a ^ b)


class UpperTree:
    """Vantage points and radii that deal fingerprints to shards; fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.nodes: list[tuple[np.uint64, int, int, int] | None] = []
        self.leaves = 0
        self.root = self._grow(sample, shards)

    def _grow(self, points: np.ndarray, shards: int) -> int:
        """A node's place in `nodes`, or -1 - number for a leaf."""
        if shards > 1 and len(points) > 16:
            vantage = points[len(points) // 2]
            distance = apart(points, vantage)
            radius = int(np.median(distance))
            inner = distance < radius
            if inner.any() and not inner.all():
                place = len(self.nodes)
                self.nodes.append(None)
                left, right = (self._grow(points[side], (shards + 1) // 2) for side in (inner, ~inner))
                self.nodes[place] = (vantage, radius, left, right)
                return place
        self.leaves += 1
        return -self.leaves

    def deal(self, fps: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, shard, home): the home shard of each fingerprint, and others to visit as its ball overlaps them."""
        found: list[tuple[np.ndarray, int, np.ndarray]] = []

        def visit(node: int, at: np.ndarray, home: np.ndarray) -> None:
            if not len(at):
                return
            if node < 0:
                found.append((at, -1 - node, home))
                return
            vantage, radius, left, right = self.nodes[node]
            distance = apart(fps[at], vantage).astype(np.int64)
            inner = distance < radius
            near = distance < radius + reach
            visit(left, at[near], home[near] & inner[near])
            near = distance >= radius - reach
            visit(right, at[near], home[near] & ~inner[near])

        visit(self.root, np.arange(len(fps)), np.ones(len(fps), bool))
        places = np.concatenate([x[0] for x in found])
        shards = np.concatenate([np.full(len(x[0]), x[1]) for x in found])
        home = np.concatenate([x[2] for x in found])
        homes = np.zeros(len(fps), np.int64)
        homes[places[home]] = shards[home]
        # Of two shards one visits: the earlier if their numbers are both odd or both even.
        kept = home | ((shards > homes[places]) == ((shards + homes[places]) % 2 == 0)) & (shards != homes[places])
        return places[kept], shards[kept], home[kept]


class Links:
    """What is connected so far among the points of one task."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            low, high = self.root[a], self.root[b]
            open_ = low != high
            if not open_.any():
                return
            a, b, low, high = a[open_], b[open_], low[open_], high[open_]
            np.minimum.at(self.root, np.maximum(low, high), np.minimum(low, high))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def search(fps: np.ndarray, points: np.ndarray, queries: np.ndarray, reach: int, add: Callable) -> None:
    """Calls add(queries, points) with all places in `fps` at most `reach` bits apart."""
    if not len(points) or not len(queries):
        return
    if len(points) > 64 and len(queries) > 16 and len(points) * len(queries) > SMALL:
        vantage = fps[points[len(points) // 2]]
        to_points, to_queries = apart(fps[points], vantage), apart(fps[queries], vantage)
        order = np.argsort(to_points, kind="stable")
        points, to_points = points[order], to_points[order].astype(np.int64)
        rings = np.unique(to_queries)
        lows = np.searchsorted(to_points, rings.astype(np.int64) - reach)
        highs = np.searchsorted(to_points, rings.astype(np.int64) + reach, side="right")
        if len(rings) > 1 or highs[0] - lows[0] < len(points):
            for ring, low, high in zip(rings, lows, highs):
                search(fps, points[low:high], queries[to_queries == ring], reach, add)
            return
    step = max(1, AT_ONCE // len(points))
    other = fps[points]
    for k in range(0, len(queries), step):
        some = queries[k : k + step]
        q, p = np.nonzero(apart(fps[some][:, None], other[None, :]) <= reach)
        if len(q):
            add(some[q], points[p])


def connect(fps: np.ndarray, home: np.ndarray, block: np.ndarray, reach: int) -> np.ndarray:
    """For each place the first place it is connected with, by links of the lower block's home points.

    With two blocks these are links from one to the other, else those within the block.
    """
    links = Links(len(fps))
    if len(fps):
        low, high = block.min(), block.max()
        search(fps, np.flatnonzero(home & (block == low)), np.flatnonzero(block == high), reach, links.add)
    return links.root


def links_within(distinct: DataFrame, reach: int, block: int = BLOCK, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """(a, b), a > b: links whose connected components are those of all pairs at most `reach` bits apart.

    `distinct` has each fingerprint once, as a long, in column fp.
    """
    n = max(distinct.count(), 1)
    shards = -(-n // shard)
    wanted = min(max(sample, LEAF * shards), MOST_SAMPLE)  # a bounded share of the fingerprints, taken by their hash
    some = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(n)) < wanted).select("fp").toArrow().column("fp")
    points = np.random.default_rng(0).permutation(np.sort(some.to_numpy().astype(np.int64)))
    tree = UpperTree(points.view(np.uint64), min(shards, wanted // LEAF))
    dealt_out = "fp long, shard int, home boolean"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(fps):
                continue
            places, shards, home = tree.deal(fps.view(np.uint64), reach)
            columns = [pa.array(fps[places]), pa.array(shards, pa.int32()), pa.array(home)]
            yield pa.RecordBatch.from_arrays(columns, names=["fp", "shard", "home"])

    dealt = stored(distinct.select("fp").mapInArrow(deal, dealt_out), "dealt")
    cut = dealt.groupBy("shard").agg(*[F.ceil(F.count_if(c) / block).alias(n) for n, c in (("homes", F.col("home")), ("guests", ~F.col("home")))])
    homes, guests = F.col("homes"), F.col("guests")
    hashed = F.xxhash64("fp")
    own = F.when(F.col("home"), F.pmod(hashed, homes)).otherwise(homes + F.pmod(hashed, guests)).cast("int")
    met = F.sequence(F.lit(0), F.when(F.col("home"), homes + guests).otherwise(homes) - 1)
    tasks = (
        dealt.join(F.broadcast(cut), "shard")  # a row for each leaf of the upper tree, fewer than 2 * MOST_SAMPLE / LEAF
        .where(homes > 0)
        .withColumn("block", own)
        .withColumn("other", F.explode(met))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
    )

    def find(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy()
        root = connect(fps.view(np.uint64), table.column("home").to_numpy(), table.column("block").to_numpy(), reach)
        linked = root != np.arange(len(root))
        a, b = fps[linked], fps[root[linked]]
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    columns = tasks.select("shard", "low", "high", "fp", "home", "block")
    return columns.groupBy("shard", "low", "high").applyInArrow(find, "a long, b long").distinct()


def contract(edges: DataFrame) -> DataFrame:
    """(a, b): each linked node but the smallest of its component, and that smallest node.

    `edges` has a > b. Alternates the large star (every neighbour above a node is tied to the node's
    smallest neighbour) and the small star (so are those below) until nothing changes.
    """
    edges, before = stored(edges, "links"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges
        before = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(lowest.select("a", F.col("m").alias("b")).union(small).distinct(), "links")


def _linked(rows: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """(fp, least, n): each fingerprint's smallest doc_id and rows; (fp, root): the smallest one connected with each that has links."""
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = contract(links_within(distinct, distance))
    return distinct, roots.union(roots.select("b", "b").distinct()).toDF("fp", "root")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id) for each row; component_id is the smallest doc_id reachable over links.

    A null or blank text has fingerprint zero and is linked like any other. Repeated rows stay; a row
    without an id takes part, but its id is never the smallest (null if no row of a component has one).
    Other columns are not looked at.
    """
    rows = stored(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    distinct, linked = _linked(rows, distance)
    known = linked.join(distinct, "fp")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    components = known.join(least, "root").select("fp", "component_id")
    least_id = F.coalesce("component_id", "least").alias("component_id")
    by_print = stored(distinct.join(components, "fp", "left").select("fp", least_id, "n"), "components")
    # The rows of frequent fingerprints, of which there are fewer than HOT_KEYS, stay where they are.
    hot = (F.col("n") > HOT_ROWS) & (F.col("n") > rows.count() / HOT_KEYS)
    few = F.broadcast(by_print.where(hot))
    frequent = rows.join(few, "fp")
    others = rows.join(few, "fp", "left_anti").join(by_print.where(~hot), "fp")
    return frequent.union(others.select(frequent.columns)).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The rows of `docs` with one document of each group of near-duplicates: that of the smallest id.

    Of a group's rows that repeat that id one stays: that of the smallest fingerprint (as a long), then text, then
    other columns as JSON. An id that is the smallest of several groups stays in each of them.
    Rows without an id are no part of any group and stay.
    """
    names, rows = docs.columns, docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    every, key, text = rows.columns, f"_{names.index('doc_id')}", f"_{names.index('text')}"
    known = rows.where(F.col(key).isNotNull())
    repeated = known.groupBy(key).count().where("count > 1").select(key)
    distinct, linked = _linked(stored(fingerprints(known, shingle, key, text), "fingerprints"), distance)
    least = F.min(F.struct(F.col("least").alias(key), "fp")).alias("c")
    grouped = distinct.join(linked, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
    chosen = stored(grouped.agg(least).select("c.*"), "chosen")
    once = rows.join(chosen, key, "left_semi").join(repeated, key, "left_anti")
    again = known.join(repeated, key, "left_semi").select(F.struct(*every).alias("row"), F.col(text).alias("text"))
    printed = fingerprints(again, shingle, doc_id="row").withColumnRenamed("doc_id", "row")
    more = printed.withColumn(key, F.col("row")[key]).join(chosen, [key, "fp"], "left_semi")
    first = F.min_by("row", F.struct(F.col("row")[text], F.to_json("row"))).alias("row")
    one = more.groupBy(key, "fp").agg(first).select("row.*")
    return once.select(every).union(one.select(every)).union(rows.where(F.col(key).isNull())).toDF(*names)
