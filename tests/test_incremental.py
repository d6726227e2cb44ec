from __future__ import annotations

import itertools
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.operators.skew import Share
from silverlane.plans.gold import gold_alerts
from silverlane.plans.incremental import ScoreStore, merged_moments, moments_by

SILVER = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("transaction_id", "user_id")]
    + [T.StructField("amount", T.DoubleType()), T.StructField("ts", T.TimestampType()), T.StructField("layer", T.StringType())]
)
SHOWN = ["transaction_id", "user_id", "zscore_alert", "window_tx", "frequency_alert", "is_fraud", "alert", "score", "risk_level", "layer"]


def silver(spark, n=400, seed=1):
    """Bursts, outliers, one user with half of the rows, users of one row or of equal amounts, and odd values."""
    draw, rows = random.Random(seed), []
    start = 1_704_067_200
    for k in range(n):
        user = draw.choice(["hot"] * 5 + [f"u{draw.randrange(8)}"] * 4 + [f"solo{k}"])
        second = start + (draw.randrange(40) if draw.random() < 0.5 else draw.randrange(4_000))
        rows.append((f"t{k}", user, draw.lognormvariate(3, 1) * (30 if draw.random() < 0.03 else 1), second))
    rows += [(f"e{k}", "equal", 0.1, start + k * 5) for k in range(60)] + [("x1", None, 5.0, start), ("x2", None, 9.0, start + 1)]
    rows += [("x3", "u1", None, start + 3), ("x4", "u2", 4.0, None), ("x5", "u2", 4.0, None)]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, amount double, s long")
    return df.select("transaction_id", "user_id", "amount", F.timestamp_seconds("s").alias("ts"), F.lit("silver").alias("layer"))


def found(df):
    return sorted((tuple(r) for r in df.select(SHOWN).collect()), key=str)


PARAMETERS = {"z_threshold": 2.5, "window_s": 30, "max_tx": 4}


def loads(rows):
    """Three loads by a hash of the id, so that each user's rows come in any order of time."""
    return {f"w{k}": rows.where(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == k) for k in range(3)}


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::3])
def test_loads_in_any_order_give_what_one_load_gives(spark, where, order):
    rows = silver(spark).cache()
    store, wanted = ScoreStore(spark, f"{where}/store", SILVER, buckets=4), found(gold_alerts(rows, **PARAMETERS))
    parts = loads(rows)
    for k in order:
        store.add(parts[f"w{k}"], f"w{k}")
        store.refresh(f"{where}/gold", f"w{k}", **PARAMETERS)
    assert found(spark.read.parquet(f"{where}/gold")) == wanted
    assert found(store.scored(share=Share(min_rows=20, max_keys=50), **PARAMETERS)) == wanted
    assert any(r[5] for r in wanted) and any(r[2] for r in wanted)
    other = {"z_threshold": 1.0, "window_s": 5, "max_tx": 1}
    assert found(store.scored(**other)) == found(gold_alerts(rows, **other))  # other thresholds, nothing counted again


def test_a_repeated_write_changes_nothing(spark, where):
    rows = silver(spark, 120).cache()
    store, parts = ScoreStore(spark, where, SILVER, buckets=4), loads(rows)
    for name in ("w0", "w1", "w0", "w2", "w1"):
        store.add(parts[name], name)
    assert found(store.scored(**PARAMETERS)) == found(gold_alerts(rows, **PARAMETERS))


def test_files_of_untouched_users_are_not_read(spark, where):
    rows = silver(spark).cache()
    store = ScoreStore(spark, f"{where}/store", SILVER, buckets=32)
    store.add(rows, "w0")
    assert len(store.refresh(f"{where}/gold", "w0", **PARAMETERS)) > 5
    store.add(rows.where("user_id = 'u3'").limit(2).withColumn("transaction_id", F.concat(F.lit("new"), "transaction_id")), "w1")
    before = {r["transaction_id"]: r["processed_at"] for r in spark.read.parquet(f"{where}/gold").where("user_id = 'hot'").collect()}
    buckets = store.touched("w1")
    assert len(buckets) == 1
    plan = store.scored(buckets, **PARAMETERS)._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    pruned = [f"(user_bucket#" in s.split("PartitionFilters: [")[1].split("]")[0] and f"= {buckets[0]})" in s for s in scans]
    assert len(scans) >= 4 and all(pruned), scans
    assert store.refresh(f"{where}/gold", "w1", **PARAMETERS) == buckets
    after = spark.read.parquet(f"{where}/gold")
    hot = store.rows().where("user_id = 'hot'").first()["user_bucket"]
    assert hot == buckets[0] or {r["transaction_id"]: r["processed_at"] for r in after.where("user_id = 'hot'").collect()} == before
    assert after.count() == rows.count() + 2


def test_moments_merge_pairwise(spark):
    draw = random.Random(3)
    parts = [[draw.gauss(1e6, 1) for _ in range(draw.randrange(1, 50))] for _ in range(20)]
    rows = spark.createDataFrame([(f"w{k:02}", "u", x) for k, part in enumerate(parts) for x in part], "write_id string, user_id string, amount double")
    whole = merged_moments(moments_by(rows, "user_id", "write_id"), "user_id").first()
    every = [x for part in parts for x in part]
    assert whole.n == len(every) and math.isclose(whole.mean, statistics.fmean(every), rel_tol=1e-15)
    assert math.isclose(whole.m2 / (whole.n - 1), statistics.variance(every), rel_tol=1e-9)
    assert (whole.low, whole.high) == (min(every), max(every))


def test_an_empty_store(spark, where):
    store = ScoreStore(spark, where, SILVER)
    assert store.scored().collect() == [] and store.touched("w0") == []
    store.add(silver(spark, 5).limit(0), "w0")
    assert store.scored().collect() == [] and store.refresh(f"{where}/gold", "w0") == []
