from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from silverlane.plans import evaluation, ranking

GOLD = (
    "write_id string, user_id string, transaction_id string, ts timestamp, amount double, city string, "
    "risk_level string, zscore_alert boolean, frequency_alert boolean, alert boolean"
)


def gold(spark, rows):
    """Scored rows of (write, user, alert); the rest follows from the place of the row."""
    some = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "k long, write_id string, user_id string, alert boolean")
    made = {
        "transaction_id": F.concat(F.lit("t"), "k"),
        "ts": F.timestamp_seconds(F.pmod(F.col("k") * 7919, F.lit(1_000))),
        "amount": F.pmod(F.col("k") * 31, F.lit(977)) + 0.25,
        "city": F.concat(F.lit("c"), F.col("k") % 13),
        "risk_level": F.when(F.col("k") % 5 == 0, "CRITICAL").when(F.col("k") % 2 == 0, "MEDIUM").otherwise("NORMAL"),
        "zscore_alert": F.col("k") % 3 == 0,
        "frequency_alert": F.col("k") % 2 == 0,
    }
    return some.withColumns(made).select(*[c.split()[0] for c in GOLD.split(", ")])


def skewed(n=20_000, users=6_000, seed=4):
    """One write has a third of all rows; a few users stand out, each in some writes only; most have one alert or none."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        write = "w0" if draw.random() < 0.33 else f"w{draw.randrange(1, 7)}"
        user = f"u{draw.randrange(users)}"
        if draw.random() < 0.3:
            user = f"v{min(int(draw.paretovariate(0.9)), 80) * 7 % 83 + int(write[1]) % 3}"
        rows.append((write, user, draw.random() < 0.8))
    return rows


def kept(rows, path):
    ranking.keep(ranking.alert_list(rows), path)
    return path


@pytest.mark.parametrize("k", [1, 10, 60, 20_000])
def test_thresholds_find_what_the_full_aggregate_finds(spark, where, k):
    rows = gold(spark, skewed())
    found = ranking.top_users(spark, kept(rows, where), k)
    wanted = evaluation.top_alerted_users(rows, k)
    assert found.dtypes == wanted.dtypes and found.collect() == wanted.collect()


def test_few_rows_move(spark, where):
    lists = spark.read.parquet(kept(gold(spark, skewed()), where))
    first = ranking.heads(lists, 10)
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    floor = ranking.floor_of(first.groupBy("user_id").agg(F.sum("total_alerts").alias("known")), 10)
    bar = ranking.bars(first, floor)
    assert 0 < bar.agg(F.sum("bar")).first()[0] <= floor
    reached = ranking.above(lists, bar)
    assert "GreaterThanOrEqual(total_alerts" in reached._jdf.queryExecution().executedPlan().toString()
    users = ranking.candidates(lists, 10)
    moved = first.count() + reached.count() + ranking.of_users(lists, users).count()
    assert moved < lists.count() / 20


def test_writes_that_come_later_are_found(spark, where):
    rows = gold(spark, skewed(4_000, 300))
    for write in ("w3", "w0", "w5"):
        kept(rows.where(F.col("write_id") == write), where)
    wanted = evaluation.top_alerted_users(rows.where("write_id in ('w0', 'w3', 'w5')"), 7)
    assert ranking.top_users(spark, where, 7).collect() == wanted.collect()


def test_ties_nulls_and_a_total_spread_thinly(spark, where):
    """A user just below all heads has the greatest total; many tie at the end of the list; null users are one user."""
    rows = [(f"w{w}", f"big{w}-{k}", True) for w in range(5) for k in range(3) for _ in range(6)]
    rows += [(f"w{w}", "spread", True) for w in range(5) for _ in range(5)]
    rows += [(None, None, True)] * 6 + [("w1", None, True)] * 2 + [("w2", "never", False)]
    scored = gold(spark, rows)
    kept(scored, where)
    for k in (1, 2, 3, 5, 16, 17, 18):
        assert ranking.top_users(spark, where, k).collect() == evaluation.top_alerted_users(scored, k).collect()
    assert ranking.top_users(spark, where, 1).first()["user_id"] == "spread"


def test_no_alerts(spark, where):
    lists = ranking.alert_list(gold(spark, [("w0", "a", False)]))
    assert ranking.candidates(lists, 3).collect() == []
    assert ranking.report(ranking.of_users(lists, ranking.candidates(lists, 3)), 3).collect() == []
