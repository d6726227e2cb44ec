from __future__ import annotations

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverlane.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    """The same by plain loops, in Python's integers."""
    usable = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if any(abs(256 * x) >= 2**63 for x in vector):
            continue
        row = label, [math.floor(256 * x) for x in vector]
        usable[i] = min(usable.get(i, row), row)
    out = []
    for a, (label, vector) in usable.items():
        if a % every:
            continue
        found = [(sum(x * y for x, y in zip(vector, v)), i, lab) for i, (lab, v) in usable.items() if i != a and len(v) == len(vector)]
        found.sort(key=lambda r: (-r[0], r[1]))
        for score, positive, _ in [r for r in found if r[2] == label][:positives]:
            near = [r for r in found if r[2] != label and low * score <= 100 * r[0] <= high * score][:negatives]
            out += [(a, positive, k, i, score, s) for k, (s, i, _) in enumerate(near, 1)]
    return sorted(out)


def mined(df, every=50, **options):
    rows = hn.mine(df, F.col("vec_id") % every == 0, **options).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in rows)


def clustered(n, dims, seed=3, scale=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dims))
    return [(k, (centres[k % 6] * scale + draw.normal(size=dims) * scale).tolist(), int(draw.integers(0, 4))) for k in range(n)]


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    rows = clustered(400, 11)
    rows += [(k + 1000, rows[7][1], k % 3) for k in range(60)]  # copies under other labels
    rows += [(7, rows[7][1], rows[7][2])] * 5 + [(8, rows[8][1], 0)]  # repeated rows, and an id with two labels
    rows += [(3000, None, 1), (3050, [0.1, None] + [0.0] * 9, 1), (3100, [float("nan")] * 11, 1), (3150, [float("-inf")] * 11, 1)]
    rows += [(3200, [0.5] * 11, None), (None, [0.5] * 11, 1), (3250, [], 1), (3251, [], 1), (3252, [], 2), (3300, [0.5, 0.5], 1)]
    rows += [(3301, [0.4, 0.5], 1), (3302, [0.2, 0.4], 2), (3350, [0.0] * 11, 1), (3400, [1e300] * 11, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    wanted = brute(rows)
    assert wanted and {r[0] for r in wanted} >= {3250, 3300}
    assert mined(df) == wanted
    assert mined(df, anchors=3) == wanted  # several blocks of anchors


def test_large_integers_and_few_candidates(spark):
    rows = [(0, [3e6, -2e6, 1.0], 0), (1, [3e6, -1e6, 0.0], 0), (2, [2e6, -1e6, 5.0], 1), (3, [-3e6, 0.0, 0.0], 1), (4, [1e6, -3e6, 2.0], 2)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows) != []


def test_empty_table_and_clashing_columns(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    rows = clustered(120, 5)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("vector", F.lit(0)).withColumn("score", F.lit(0))
    assert mined(df, relabel=F.col("label")) == brute(rows) != []


def test_relabelled(spark):
    rows = clustered(200, 8)
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 4).otherwise(F.col("label"))
    changed = [(i, v, (lab + 1) % 4 if i % 7 == 0 else lab) for i, v, lab in rows]
    assert mined(spark.createDataFrame(rows, SCHEMA), relabel=relabel) == brute(changed)


@settings(max_examples=150, deadline=None, derandomize=True)
@given(data=st.data(), n=st.integers(0, 20), bits=st.integers(1, 28))
def test_scores_are_inner_products(data, n, bits):
    whole = st.lists(st.integers(-(2**bits), 2**bits - 1), min_size=n, max_size=n)
    a, b = (data.draw(st.lists(whole, min_size=1, max_size=most)) for most in (4, 9))
    a, b = np.array(a, np.int64).reshape(len(a), n), np.array(b, np.int64).reshape(len(b), n)
    n_planes, planes = hn.bit_planes(b)
    assert len(planes) == n_planes
    assert hn.scores(hn.subset_sums(a), planes).tolist() == (b @ a.T).tolist()


@settings(max_examples=150, deadline=None, derandomize=True)
@given(parts=st.lists(st.lists(st.integers(-4, 4), max_size=60), max_size=5), keep=st.integers(1, 4))
def test_best_rows_of_a_task(parts, keep):
    best, every = hn.Best(keep), []
    for part in parts:
        ids = np.arange(len(every), len(every) + len(part))
        best.add((0, 0), np.array(part, np.int64), ids)
        every += [(-s, i) for s, i in zip(part, ids.tolist())]
    got = best.rows.get((0, 0), (np.zeros(0), np.zeros(0)))
    assert [(-s, i) for s, i in zip(got[0].tolist(), got[1].tolist())] == sorted(every)[:keep]
