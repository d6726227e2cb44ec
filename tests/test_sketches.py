from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from silverlane.operators import sketches
from silverlane.sources import footers


def rows(spark, n=20_000, seed=2):
    draw = random.Random(seed)
    made = [(f"w{draw.randrange(5)}", draw.choice("aab"), draw.lognormvariate(3, 2) if draw.random() < 0.7 else 7.0) for _ in range(n)]
    made += [("w0", "a", None), ("w0", None, 1.0), ("w9", "empty", None)]
    return spark.createDataFrame(made, "write string, channel string, amount double").repartition(6).cache()


def test_percentiles_of_merged_sketches_are_near_in_rank(spark, where):
    wanted, some = {"low": 0.01, "median": 0.5, "p95": 0.95, "top": 1.0}, rows(spark)
    sketches.amount_sketches(some, "write", "channel").write.parquet(where)
    found = sketches.quantiles_of(spark.read.parquet(where), "channel", wanted).cache()
    exact = {r["channel"]: r["n"] for r in some.where("amount is not null").groupBy("channel").agg(F.count("*").alias("n")).collect()}
    assert {r["channel"]: r["total"] for r in found.collect()} == exact
    errors = sketches.rank_errors(some, found, "channel", wanted).collect()
    assert len(errors) == len(exact) == 3
    assert all(r[name] <= sketches.RANK_ERROR for r in errors for name in wanted)
    wrong = found.withColumn("median", F.col("p95"))
    assert max(r["median"] for r in sketches.rank_errors(some, wrong, "channel", wanted).collect()) > 0.3


def test_sketches_are_combined_before_the_shuffle(spark):
    plan = sketches.amount_sketches(rows(spark, 50), "channel")._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_double" in plan


@pytest.mark.parametrize("n, exact", [(3_000, True), (60_000, False)])
def test_sets_of_users_are_exact_up_to_the_size(spark, n, exact):
    some = spark.range(n).select(F.concat(F.lit("u"), "id").alias("user"), F.explode(F.array(F.lit("w0"), F.lit("w1"), F.lit("w0"))).alias("write"), "id")
    some = some.where("write = 'w0' and id % 3 < 2 or write = 'w1' and id % 3 > 0").union(spark.sql("select null, 'w0', 0L"))
    found = {r["combined"]: r for r in sketches.compare_sets(sketches.distinct_sketches(some, "user", "write"), "write", "w0", "w1").collect()}
    third = n // 3
    truth = {"first": 2 * third, "second": 2 * third, "either": n, "both": third, "first only": third, "second only": third}
    if exact:
        assert {k: r["n_distinct"] for k, r in found.items()} == truth and {r["relative_error"] for r in found.values()} == {0.0}
    else:
        assert all(0 < r["relative_error"] < 0.02 and abs(r["n_distinct"] - truth[k]) < 8 * r["relative_error"] * n for k, r in found.items())


def test_no_sketches(spark):
    none = rows(spark, 10).limit(0)
    assert sketches.quantiles_of(sketches.amount_sketches(none, "channel"), "channel", {"m": 0.5}).collect() == []


def test_counts_and_bounds_come_from_the_footers(spark, where):
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.sources.useV1SourceList")
    made = spark.range(5_000).select((F.col("id") * 1.5).alias("amount"), F.when(F.col("id") % 4 == 0, "bronze").otherwise("silver").alias("layer"))
    made.repartition(3).write.partitionBy("layer").parquet(where)
    counted = footers.footer_aggregate(spark, where, ["amount"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(amount), MAX(amount)]" in plan and "PushedGroupBy: [layer]" in plan
    found = {r["layer"]: r for r in footers.layer_file_stats(spark, where, ["amount"]).collect()}
    assert (found["bronze"]["n_rows"], found["bronze"]["min_amount"], found["bronze"]["max_amount"]) == (1250, 0.0, 4996 * 1.5)
    assert found["silver"]["n_rows"] == 3750 and found["silver"]["n_files"] == 3 and found["silver"]["total_bytes"] > 1000
    scan = footers.file_stats(spark, where)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in scan
    assert before == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.sources.useV1SourceList"))
