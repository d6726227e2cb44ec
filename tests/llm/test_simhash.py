from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from silverlane.llm import simhash


def slow_fingerprint(text, k=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, reach):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= reach).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def flipped(x, n, rng):
    for bit in rng.choice(64, n, replace=False):
        x ^= np.uint64(1) << np.uint64(bit)
    return x


def prints(rng, n, groups, copies):
    some = rng.integers(0, 2**64, n, dtype=np.uint64)
    near = [flipped(some[rng.integers(0, groups)], int(rng.integers(0, 7)), rng) for _ in range(copies)]
    out = np.unique(np.concatenate([some, np.array(near, np.uint64)]))
    rng.shuffle(out)
    return out


def test_fingerprints(odd_texts):
    texts = odd_texts + ["a b", "a b c d", "A B c D e", "one two three four five six seven eight " * 3]
    assert [simhash.fingerprint(t, 4) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_trees_find_all_links():
    rng = np.random.default_rng(5)
    for reach in (0, 4, 9):
        fps = prints(rng, 900, 30, 900)
        got = simhash.connect(fps, np.ones(len(fps), bool), np.zeros(len(fps), int), reach)
        assert got.tolist() == slow_components(fps, reach)


def test_upper_tree_overlooks_no_link():
    rng = np.random.default_rng(6)
    fps = prints(rng, 1500, 40, 1500)
    places, shards, home = simhash.UpperTree(fps[:700], 20).deal(fps, 4)
    homes = dict(zip(places[home].tolist(), shards[home].tolist()))
    assert sorted(homes) == list(range(len(fps)))
    visits = set(zip(places.tolist(), shards.tolist()))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= 4).tolist():
            assert ((i, homes[j]) in visits) != ((j, homes[i]) in visits) or homes[i] == homes[j]


def test_links_do_not_depend_on_shards_and_blocks(spark):
    rng = np.random.default_rng(7)
    fps = prints(rng, 500, 10, 900)
    distinct = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    wanted = slow_components(fps, 4)
    groups = {frozenset(np.flatnonzero(np.array(wanted) == r).tolist()) for r in set(wanted)}
    place = {int(x): k for k, x in enumerate(fps.view(np.int64))}
    for block, shard, sample in ((32_768, 16_384, 16_384), (60, 16_384, 16_384), (50, 100, 16_384), (50, 20, 8), (7, 700, 8)):
        edges = simhash.contract(simhash.links_within(distinct, 4, block, shard, sample)).collect()
        root = {place[e.a]: place[e.b] for e in edges}
        by: dict = {}
        for k in range(len(fps)):
            by.setdefault(root.get(k, k), set()).add(k)
        assert set(map(frozenset, by.values())) == groups


def test_the_upper_tree_grows_with_the_shards_wanted(spark):
    rng = np.random.default_rng(8)
    fps = rng.integers(0, 2**64, 4096, dtype=np.uint64)
    for shards in (1, 8, 64, 128):
        tree = simhash.UpperTree(fps[: simhash.LEAF * shards], shards)
        assert tree.leaves == shards
        _, found, home = tree.deal(fps, 4)
        assert np.bincount(found[home], minlength=shards).max() < 4 * len(fps) / shards
    empty = spark.createDataFrame([], "fp long")
    assert simhash.links_within(empty, 4).collect() == []


def test_frequent_fingerprints_are_looked_up_apart(documents, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", 3)
    base = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark wood " * 4
    rows = [(k, base) for k in range(20, 40)] + [(k, None) for k in range(50, 60)] + [(7, "alone"), (45, base), (45, base)]
    for keys in (10_000, 3, 1):  # both are frequent, one, none
        monkeypatch.setattr(simhash, "HOT_KEYS", keys)
        got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(documents(rows)).collect())
        assert got == sorted((k, 7 if t == "alone" else 20 if t else 50) for k, t in rows)


def test_long_chains_are_one_component(spark):
    n = 300
    edges = spark.createDataFrame([(k + 1, k) for k in range(n)] + [(1000, 999)], "a long, b long")
    got = {(r.a, r.b) for r in simhash.contract(edges).collect()}
    assert got == {(k, 0) for k in range(1, n + 1)} | {(1000, 999)}


def test_near_duplicates_of_odd_rows(documents, odd_texts):
    base = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark wood " * 4
    rows = [(k, t) for k, t in enumerate(odd_texts)] + [(100, base), (90, base), (95, base + "x"), (90, base), (None, base)]
    docs = documents(rows).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1)).withColumn("DOC_IDS", F.lit(0))
    got = sorted((str(r.doc_id), r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect())
    fps = np.array([slow_fingerprint(t) for _, t in rows], np.uint64)
    roots = slow_components(fps, 4)
    least = {r: min(rows[k][0] for k in range(len(rows)) if roots[k] == r and rows[k][0] is not None) for r in roots}
    assert got == sorted((str(k), int(f), least[r]) for (k, _), f, r in zip(rows, fps, roots))
    assert simhash.near_duplicates(documents([])).collect() == []


def test_one_of_each_keeps_the_smallest_id(documents):
    base = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark wood " * 4
    rows = [(7, base), (3, base), (3, base), (5, "something else altogether"), (None, base), (9, None), (8, "")]
    docs = documents(rows)
    clash = docs.withColumn("x", F.lit(1)).toDF(*docs.columns, "DOC_ID")
    got = simhash.one_of_each(clash)
    assert got.columns == clash.columns
    assert sorted(str(r[0]) for r in got.collect()) == ["3", "5", "8", "None"]


def test_one_of_each_with_an_id_of_several_texts(documents):
    a = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark wood " * 4
    b = "a wholly different text on how to bake bread with flour and water and salt at home " * 4
    docs = documents([(5, a), (5, b), (3, b)]).withColumn("more", F.create_map("doc_id", "source"))
    assert sorted((r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()) == [(3, b), (5, a)]
    copies = [(5, a, "en"), (5, b, "en"), (5, b, "de"), (5, a.upper(), "en"), (7, b, "en")]
    for rows in (copies, copies[::-1]):
        got = sorted((r.doc_id, r.text, r.lang) for r in simhash.one_of_each(documents(rows)).collect())
        assert got == sorted([(5, a.upper(), "en"), (5, b, "de")])
