"""The prefix trie of conversations whose beginnings were taken over from others.

A sequence of turns has as fingerprint the product of its turns' hashes in a monoid: (n, v) stands for n turns and the sum of
hash * base^place over them, and (n, v)(m, w) = (n + m, v + base^n w), modulo the prime 2^61 - 1, for two bases at once.
Products can be taken of any pieces and combined, and a leading piece can be divided out again. So

* turns are scanned in ranges of (conversation, turn), and what earlier ranges have of a conversation is
  multiplied in front, one row for each range: no conversation has to be in one task;
* the prefixes of a rebuilt conversation are alpha * v + beta of those of the original: the head's product of the
  other conversation, times the own prefix with its first turns divided out. No rebuilt text is ever made.

Conversations with the same fingerprint at the same depth are one node. That is checked: of the stored turns that
the members of a node refer to, role and text must be equal, and so must the nodes before them. By induction
all prefixes are then equal. Should a node fail, everything is done again with other bases and hashes.

Sums over subtrees need no walk over the levels. A node belongs to its smallest member, and a conversation owns
the nodes of its path from some depth on. So a subtree is what its members own, less what
its own owner has above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count, groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from silverlane.llm.store import pick, stored

PRIME = 2**61 - 1
#: Depths that are summed up by one window at a time.
STRETCH = 1_024
#: Characters of ids that are joined before they travel.
JOINED = 500_000
NODE = ["depth", "f1", "f2"]


def bases(attempt: int) -> list[int]:
    """Two numbers below the prime for each attempt."""
    digests = (hashlib.sha256(f"{attempt} {k}".encode()).digest() for k in (1, 2))
    return [int.from_bytes(d[:8], "little") % (PRIME - 2) + 2 for d in digests]


def affine(a: Column, v: Column, b: Column) -> Column:
    """(a v + b) modulo the prime, of numbers below it: 37 digits at most, so decimals hold it."""
    a, v, b = (c.cast("decimal(20,0)") for c in (a, v, b))
    return ((a * v + b) % F.lit(PRIME).cast("decimal(20,0)")).cast("long")


def turns_of(conversations: DataFrame, attempt: int, **names: str) -> DataFrame:
    """The turns in order, each with the products of its conversation's turns before and after it within its range.

    (conv_id, role, text, n_bytes, part, place, before1, before2, after1, after2); `place` counts from 1 within the range.
    """
    rows = pick(conversations, **names).where(F.col("conv_id").isNotNull())
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    # The texts' beginnings are in the ranges too, or a conversation of one turn number would be one task's work.
    dealt = rows.withColumn("begins", F.substring("text", 1, 64)).repartitionByRange("conv_id", "turn", "role", "begins")
    hashed = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select(
        "conv_id",
        "role",
        "text",
        "n_bytes",
        *[F.pmod(F.xxhash64(F.lit(2 * attempt + k), "role", "text"), F.lit(PRIME)).alias(f"x{k}") for k in (1, 2)],
    )
    longs = ("place", "before1", "before2", "after1", "after2")
    schema = T.StructType(
        [*hashed.schema.fields[:4], T.StructField("part", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in longs]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, (b1, b2) = TaskContext.get().partitionId(), bases(attempt)
        current, state = None, None
        for batch in batches:
            out = []
            for conv, x1, x2 in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "x1", "x2"))):
                if state is None or conv != current:
                    current, state = conv, (0, 0, 0, 1, 1)
                n, v1, v2, w1, w2 = state
                after1, after2 = (v1 + x1 * w1) % PRIME, (v2 + x2 * w2) % PRIME
                out.append((n + 1, v1, v2, after1, after2))
                state = n + 1, after1, after2, w1 * b1 % PRIME, w2 * b2 % PRIME
            made = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 5
            parts = pa.array([part] * len(out), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], parts, *made], names=schema.names)

    return hashed.mapInArrow(run, schema)


def with_carries(turns: DataFrame, attempt: int) -> DataFrame:
    """The same with places and products from the beginning of the conversation.

    Only a range's first conversation can have begun before it, so what is brought along is a row for each range.
    """
    spark = turns.sparkSession
    edges = turns.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high")).orderBy("part").collect()
    spanning = sorted({b.low for a, b in zip(edges, edges[1:]) if a.high == b.low})
    if not spanning:
        return turns
    conv = T.StructType([T.StructField("conv_id", turns.schema["conv_id"].dataType)])
    runs = (
        turns.join(F.broadcast(spark.createDataFrame([(c,) for c in spanning], conv)), "conv_id")
        .groupBy("conv_id", "part")
        .agg(F.max(F.struct("place", "after1", "after2")).alias("last"))
        .orderBy("conv_id", "part")
        .collect()
    )
    carried, (b1, b2) = [], bases(attempt)
    for key, group in groupby(runs, key=lambda r: r.conv_id):
        n, v1, v2 = 0, 0, 0
        for run in group:
            w1, w2 = pow(b1, n, PRIME), pow(b2, n, PRIME)
            carried.append((key, run.part, n, v1, v2, w1, w2))
            n, v1, v2 = n + run.last.place, (v1 + w1 * run.last.after1) % PRIME, (v2 + w2 * run.last.after2) % PRIME
    fields = [T.StructField("part", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("n", "c1", "c2", "w1", "w2")]]
    carries = spark.createDataFrame([c for c in carried if c[2]], T.StructType([*conv.fields, *fields]))
    joined = turns.join(F.broadcast(carries), ["conv_id", "part"], "left")
    whole = {"place": F.col("place") + F.coalesce("n", F.lit(0))}
    for column in ("before1", "before2", "after1", "after2"):
        k = column[-1]
        whole[column] = F.when(F.col("n").isNull(), F.col(column)).otherwise(affine(F.col(f"w{k}"), F.col(column), F.col(f"c{k}")))
    return joined.withColumns(whole).select(turns.columns)


def rebuilt(turns: DataFrame, head: Column, base: Column, most: int, attempt: int) -> DataFrame:
    """One row for each conversation: its lengths, the head it takes over, and alpha and beta of its own prefixes.

    (conv_id, h, m, length, is_base, alpha1, alpha2, beta1, beta2, head).
    """
    first = F.when(F.col("place") <= most, F.struct("place", "after1", "after2", "n_bytes"))
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(first)).alias("first"))
    own = own.withColumns({"h": head.cast("int"), "base": base})
    others = own.select(F.col("conv_id").alias("base"), F.col("first").alias("theirs"))
    asked = own.select(F.col("base").alias("conv_id")).distinct().withColumn("is_base", F.lit(True))
    both = own.join(others, "base", "left").join(asked, "conv_id", "left")
    both = both.withColumn("m", F.least("h", F.coalesce(F.size("theirs"), F.lit(0))))
    divided = {}
    for k, b in enumerate(bases(attempt), 1):
        inverse = F.array(*[F.lit(pow(b, -j, PRIME)) for j in range(most + 1)])
        alpha = F.get(inverse, F.col("h") - F.col("m"))
        ahead = F.coalesce(F.get(F.col("theirs")[f"after{k}"], F.col("m") - 1), F.lit(0))
        gone = F.coalesce(F.get(F.col("first")[f"after{k}"], F.col("h") - 1), F.lit(0))
        divided[f"alpha{k}"] = alpha
        divided[f"beta{k}"] = affine(alpha, F.lit(PRIME) - gone, ahead)
    return both.withColumns(divided).select(
        "conv_id",
        "base",
        "h",
        "m",
        (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        F.coalesce("is_base", F.lit(False)).alias("is_base"),
        "alpha1",
        "alpha2",
        "beta1",
        "beta2",
        F.slice(F.coalesce("theirs", F.array().cast(own.schema["first"].dataType)), 1, F.col("m")).alias("head"),
    )


def _moved(column: str) -> Column:
    k = column[-1]
    return affine(F.col(f"alpha{k}"), F.col(column), F.col(f"beta{k}"))


def suffixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The own turns that stay, with their depth, the fingerprint there, and that of the node before."""
    kept = turns.join(convs.drop("head"), "conv_id").where(F.col("place") > F.col("h"))
    depth = F.col("m") + F.col("place") - F.col("h")
    return kept.select(
        "conv_id",
        depth.alias("depth"),
        *[_moved(f"after{k}").alias(f"f{k}") for k in (1, 2)],
        *[_moved(f"before{k}").alias(f"p{k}") for k in (1, 2)],
        "n_bytes",
        (depth == F.col("length")).alias("ends"),
        F.col("conv_id").alias("turn_conv_id"),
        F.col("place").alias("turn_place"),
        "role",
        "text",
    )


def members_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each node on the path of each conversation, with the stored turn it refers to."""
    at, before = F.get("head", F.col("k")), F.get("head", F.col("k") - 1)
    heads = convs.select("*", F.posexplode("head").alias("k", "turn")).select(
        "conv_id",
        (F.col("k") + 1).cast("long").alias("depth"),
        *[at[f"after{k}"].alias(f"f{k}") for k in (1, 2)],
        *[F.coalesce(before[f"after{k}"], F.lit(0)).alias(f"p{k}") for k in (1, 2)],
        F.col("turn.n_bytes").alias("n_bytes"),
        (F.col("k") + 1 == F.col("length")).alias("ends"),
        F.col("base").alias("turn_conv_id"),
        F.col("turn.place").alias("turn_place"),
    )
    none = F.lit(None)
    roots = convs.select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        *[F.lit(0).cast("long").alias(f"f{k}") for k in (1, 2)],
        *[none.cast("long").alias(f"p{k}") for k in (1, 2)],
        F.lit(0).cast("long").alias("n_bytes"),
        (F.col("length") == 0).alias("ends"),
        none.cast(convs.schema["conv_id"].dataType).alias("turn_conv_id"),
        none.cast("long").alias("turn_place"),
    )
    return roots.union(heads).union(suffixes(turns, convs).drop("role", "text"))


def mixed(turns: DataFrame, convs: DataFrame, most: int) -> DataFrame:
    """The nodes whose turns are not all the same, or that follow on different nodes; none, but for a collision.

    Each stored turn counts once: as an own turn that stays, and as one that others take over.
    """
    given = turns.where(F.col("place") <= most).join(convs.where("is_base").select("conv_id"), "conv_id")
    taken = given.select(
        F.col("place").alias("depth"),
        *[F.col(f"after{k}").alias(f"f{k}") for k in (1, 2)],
        *[F.col(f"before{k}").alias(f"p{k}") for k in (1, 2)],
        "role",
        "text",
    )
    said = F.struct("p1", "p2", "role", "text")
    every = suffixes(turns, convs).select(taken.columns).union(taken)
    return every.groupBy(*NODE).agg(F.min(said).alias("low"), F.max(said).alias("high")).where(F.col("low") != F.col("high"))


def end_digests(members: DataFrame) -> DataFrame:
    """(node, ends_sha256): of the ids of the conversations that end in a node, in order.

    Ids are sorted by ranges and joined there, so what a digest reads one after the other is few long rows.
    """
    ends = members.where("ends").select(*NODE, "conv_id")
    joined = T.StructType([*ends.schema.fields, T.StructField("ids", T.StringType())])
    digest = T.StructType([*ends.schema.fields[:3], T.StructField("ends_sha256", T.StringType())])

    def batch_of(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, chars = [], 0
        for node, group in groupby(rows_of(batches), key=lambda r: r[:3]):
            first, ids, size = None, [], 0
            for *_, conv in group:
                first = conv if first is None else first
                ids.append(str(conv))
                size += len(ids[-1]) + 1
                if size >= JOINED:
                    yield batch_of([(*node, first, ",".join(ids))], joined)
                    first, ids, size = None, [], 0
            if ids:
                done.append((*node, first, ",".join(ids)))
                chars += size
            if chars >= JOINED or len(done) >= 5_000:
                yield batch_of(done, joined)
                done, chars = [], 0
        if done:
            yield batch_of(done, joined)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for node, group in groupby(rows_of(batches), key=lambda r: r[:3]):
            state, begun = hashlib.sha256(), False
            for *_, ids in group:
                state.update(("," if begun else "").encode() + ids.encode())
                begun = True
            done.append((*node, state.hexdigest()))
            if len(done) >= 5_000:
                yield batch_of(done, digest)
                done = []
        if done:
            yield batch_of(done, digest)

    order = [*NODE, "conv_id"]
    few = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, joined)
    return few.repartition(*NODE).sortWithinPartitions(*order).mapInArrow(hashed, digest)


def build(
    conversations: DataFrame,
    head: Column,
    base: Column,
    most: int,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations.

    A conversation is rebuilt as the first `head` turns of conversation `base` (all, if there are fewer, none if there is
    no such conversation), then its own turns after its first `head`. Both are expressions over conv_id;
    `most` is the greatest value of `head`. (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, turn_conv_id, turn_place): conv_id is the smallest member, and the last two name the stored turn
    the node ends with, by its conversation and its place there from 1; both are null at the root.

    Turns are ordered by turn, null first, then by role and text, where null counts as empty; repeated rows are turns
    of their own. Rows without conv_id take no part. A conversation with nothing left is a member of the
    root alone. Without conversations there are no nodes. Other columns are not looked at.
    """
    names = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    for attempt in count():
        turns = with_carries(stored(turns_of(conversations, attempt, **names), "turns"), attempt)
        convs = stored(rebuilt(turns, head, base, most, attempt), "conversations")
        if mixed(turns, convs, most).isEmpty():
            break
    members = stored(members_of(turns, convs), "members")
    first = F.min(F.struct("turn_conv_id", "turn_place"))
    nodes = stored(
        members.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.first("n_bytes").alias("n_bytes"),
            F.first("p1").alias("p1"),
            F.first("p2").alias("p2"),
            first.alias("ref"),
        ),
        "nodes",
    )
    above = (F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")
    children = nodes.where("depth > 0").select(*above).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    saved = (F.col("n_convs") - 1) * F.col("n_bytes")
    known = nodes.join(children, NODE, "left").withColumn("saved", saved).withColumn("stretch", F.floor(F.col("depth") / STRETCH))
    known = stored(known.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "known")

    childless = F.sum((F.col("n_children") == 0).cast("long"))
    owned = known.groupBy("conv_id").agg(F.sum("saved").alias("saved"), childless.alias("leaves"))
    inside = members.select("conv_id", *NODE).join(owned, "conv_id")
    below = inside.groupBy(*NODE).agg(F.sum("saved").alias("theirs"), F.sum("leaves").alias("n_leaves"))

    ahead = Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = known.groupBy("conv_id", "stretch").agg(F.sum("saved").alias("all"))
    whole = whole.select("conv_id", "stretch", F.sum("all").over(earlier).alias("earlier")).where("earlier > 0")
    placed = known.withColumn("ahead", F.sum("saved").over(ahead)).join(whole, ["conv_id", "stretch"], "left")

    parents = nodes.where("depth > 0").select("depth", "f1", "f2", F.col("conv_id").alias("parent"))
    root = nodes.where("depth = 0").select("conv_id").first()  # one value for all nodes of depth 1
    of_root = F.lit(None if root is None else root.conv_id).cast(nodes.schema["conv_id"].dataType)
    up = [F.col("nodes.depth") == F.col("parents.depth") + 1, F.col("p1") == F.col("parents.f1"), F.col("p2") == F.col("parents.f2")]
    nothing = F.lit(0).cast("long")
    joined = (
        placed.join(below, NODE).join(end_digests(members), NODE, "left").alias("nodes").join(parents.alias("parents"), up, "left")
    )
    return joined.select(
        "conv_id",
        "nodes.depth",
        F.when(F.col("nodes.depth") == 1, of_root).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("theirs") - F.coalesce("ahead", nothing) - F.coalesce("earlier", nothing)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        "ref.turn_conv_id",
        "ref.turn_place",
    )


#: The trie of the registered query, in SQL: heads of crc32(conv_id) % 9 turns of conversation conv_id - conv_id % 5.
SQL = """
WITH own AS (
  SELECT conv_id, list(struct_pack(r := r, t := t) ORDER BY turn NULLS FIRST, r, t) AS turns
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
cut AS (
  SELECT *, xor(list_reduce(
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
      lambda c, s: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
        lambda k, i: CASE WHEN k & 1 = 1 THEN xor(k >> 1, 3988292384) ELSE k >> 1 END, xor(c, s)),
      CAST(4294967295 AS BIGINT)), 4294967295) % 9 AS h
  FROM own),
built AS (
  SELECT c.conv_id, coalesce(b.turns[1:c.h], []) || c.turns[c.h + 1:] AS turns
  FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
members AS (
  SELECT conv_id, d, turns[1:d] AS prefix, d = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM built)),
nodes AS (
  SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(prefix[d].t)) END AS saved
  FROM members GROUP BY d, prefix),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.prefix[1:n.d] = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.prefix = n.prefix[1:n.d - 1])
SELECT n.conv_id, n.d AS depth, n.parent_conv_id, n.n_convs, n.n_children,
  count(*) FILTER (s.n_children = 0) AS n_leaves, CAST(sum(s.saved) AS BIGINT) AS saved_tokens, n.ends_sha256
FROM linked n JOIN linked s ON s.d >= n.d AND s.prefix[1:n.d] = n.prefix
GROUP BY n.conv_id, n.d, n.parent_conv_id, n.n_convs, n.n_children, n.ends_sha256, n.prefix
"""
