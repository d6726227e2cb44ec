from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from silverlane.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def truncated(n, m):
    return n - m * int(n / m)


def brute(rows):
    """The nodes by rebuilding every conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        built = turns.get(c - truncated(c, 5), [])[:h] + turns[c][h:]
        for d in range(len(built) + 1):
            members[tuple(built[:d])].append((c, d == len(built)))
    children, out = defaultdict(list), []
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    sums = {}
    for prefix in sorted(members, key=len, reverse=True):
        saved = (len(members[prefix]) - 1) * (len(prefix[-1][1]) if prefix else 0)
        below = [sums[c] for c in children[prefix]]
        sums[prefix] = saved + sum(s for s, _ in below), sum(n for _, n in below) or 1
    for prefix, found in members.items():
        ends = ",".join(str(c) for c, e in sorted(found) if e)
        parent = min(members[prefix[:-1]])[0] if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(found)[0], len(prefix), parent, len(found), len(children[prefix]), sums[prefix][1], sums[prefix][0], digest))
    return sorted(out, key=str)


def built(df, **options):
    conv = F.col("conv_id")
    nodes = prefix_trie.build(df, F.crc32(conv.cast("string")) % 9, conv - conv % 5, 8, **options)
    return sorted((tuple(r) for r in nodes.select(COLUMNS).collect()), key=str)


def talks(n, seed=1, longest=14, words=3):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(draw.randrange(1, longest)):
            rows.append((c * draw.choice((1, 1, 1, 3)), turn, ("user", "assistant")[turn % 2], draw.choice("abcdefg"[:words]) * draw.randrange(1, 3)))
    return rows


def test_equals_rebuilding_all(spark):
    rows = talks(120) + talks(40, 2, 30, 1)
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(5)]  # copies
    assert built(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)


def test_odd_rows(spark):
    rows = [(3, None, "user", "first"), (3, None, None, None), (3, 1, "user", "é" * 3), (3, 1, "user", "é" * 3), (3, 1, "a", "z")]
    rows += [(None, 0, "user", "nobody"), (-7, 0, "user", "below zero"), (-5, 0, None, "x" * 100_000), (-5, 1, "", ""), (-9, 0, "user", "")]
    rows += [(17, t, "user", "alone") for t in range(12)] + [(c, 0, "user", "one turn") for c in range(40, 60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert built(df) == brute(rows)
    clash = df.withColumn("place", F.lit(1)).withColumn("part", F.lit(2)).withColumn("f1", F.lit(3)).withColumn("x", F.lit(1))
    assert built(clash.toDF(*[c if c != "x" else "TEXT" for c in clash.columns])) == brute(rows)


def test_empty_table(spark):
    assert built(spark.createDataFrame([], SCHEMA)) == []


def test_a_long_conversation_lies_in_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 64)
    rows = [(10, t, "user", f"t{t % 7}") for t in range(1500)] + [(11, t, "user", f"t{t % 7}") for t in range(1400)]
    rows += [(c, t, "user", "x") for c in range(12, 30) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    conv = F.col("conv_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = prefix_trie.turns_of(df, 0, conv_id="conv_id", turn="turn", role="role", text="text")
        assert turns.where("conv_id = 10").select("part").distinct().count() > 1
        nodes = prefix_trie.build(df, F.lit(3), conv - conv % 5, 3).select(COLUMNS).collect()
        many = talks(60) + [(c, t, "user", "same") for c in range(200, 260) for t in range(5)]
        assert built(spark.createDataFrame(many, SCHEMA)) == brute(many)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    deepest = max(nodes, key=lambda r: r.depth)
    assert deepest.depth == 1500 and deepest.n_convs == 1
    shared = [r for r in nodes if r.conv_id == 10 and 3 < r.depth <= 1400]
    assert len(shared) == 1397 and {r.n_convs for r in shared} == {2}
    sizes = [0, *[len(f"t{t % 7}") for t in range(1500)]]
    for r in shared:
        assert r.saved_tokens == sum(sizes[r.depth : 1401]) and r.n_leaves == 1


def test_collisions_are_found_and_done_again(spark, monkeypatch):
    rows = talks(40)
    df, wanted = spark.createDataFrame(rows, SCHEMA), brute(rows)
    real, asked = prefix_trie.bases, []

    def degenerate(attempt):
        asked.append(attempt)
        return [1, 1] if attempt == 0 else real(attempt)  # with base 1 the order of turns does not count

    monkeypatch.setattr(prefix_trie, "bases", degenerate)
    swapped = [(500, t, "user", w) for t, w in enumerate("ab" * 6)] + [(500 + 5, t, "user", w) for t, w in enumerate("ba" * 6)]
    both = rows + swapped
    assert built(spark.createDataFrame(both, SCHEMA)) == brute(both)
    assert max(asked) >= 1
    monkeypatch.undo()
    assert built(df) == wanted


def test_references_name_the_last_turn(spark):
    rows = talks(60, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    conv = F.col("conv_id")
    nodes = prefix_trie.build(df, F.lit(2), conv - conv % 5, 2).collect()
    turns = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        turns[c].append(text)
    rebuilt = {c: turns.get(c - c % 5, [])[:2] + t[2:] for c, t in turns.items()}
    for r in nodes:
        if r.depth:
            assert turns[r.turn_conv_id][r.turn_place - 1] == rebuilt[r.conv_id][r.depth - 1]


@pytest.mark.parametrize("attempt", [0, 3])
def test_affine_arithmetic(spark, attempt):
    big = [prefix_trie.PRIME - 1, *prefix_trie.bases(attempt), 0, 1]
    rows = [(a, v, b) for a in big for v in big for b in big]
    df = spark.createDataFrame(rows, "a long, v long, b long")
    got = df.select("a", "v", "b", prefix_trie.affine(F.col("a"), F.col("v"), F.col("b")).alias("r")).collect()
    assert all(r.r == (r.a * r.v + r.b) % prefix_trie.PRIME for r in got)
