"""Every registered query against its SQL, and the shape of the important plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check_oracle import difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert entry.queries()[name](spark, SF).count() > 0
    else:
        assert difference(spark, SF, entry.queries()[name], sql) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 743


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def executed(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_gold_over_a_table_exchanges_its_rows_once(spark, where):
    from silverlane.plans.gold import gold_alerts
    from workload.inputs import silver

    silver(spark, SF).write.parquet(where)
    plan = executed(gold_alerts(spark.read.parquet(where)))
    assert plan.count("Exchange hashpartitioning") == 2  # the rows, and one row of statistics for each user and task
    assert plan.count("FileScan parquet") == 2 and plan.count("Window [") == 2
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_gold_over_computed_rows_cleans_them_once(spark):
    from silverlane.plans.gold import gold_alerts
    from workload.inputs import silver

    gold = gold_alerts(silver(spark, SF))
    plan = executed(gold)
    # The statistics are made of the rows that the removal of copies has shuffled already.
    assert "ReusedExchange" in plan and plan.count("FileScan parquet") == 1


def test_reports_read_only_the_columns_they_need(spark, where):
    from silverlane.plans.profiles import profile_by_city
    from workload.inputs import silver

    silver(spark, SF).write.parquet(where)
    plan = profile_by_city(spark.read.parquet(where))._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and not any("device" in s or "transaction_id" in s for s in scans)


def test_a_city_profile_reads_its_input_once(spark):
    from silverlane.plans.profiles import profile_by_city
    from workload.inputs import silver

    profile = profile_by_city(silver(spark, SF))
    executed(profile)
    # The total is summed over the groups, whose input is the same shuffle once more.
    assert "ReusedExchange" in profile._jdf.queryExecution().executedPlan().toString()


def test_chained_detectors_over_one_split_read_it_few_times(spark, where):
    from silverlane.operators import detect
    from silverlane.operators.skew import Share, split_by_share
    from workload.inputs import silver

    silver(spark, SF).write.parquet(where)
    rows = spark.read.parquet(where)
    split = split_by_share(rows, ["user_id"], Share(min_rows=40, max_keys=1_000))
    assert split.frequent is not None
    chained = (
        split.transform(detect.zscore_alerts)
        .transform(detect.frequency_alerts, window_s=86_400, max_tx=5)
        .transform(detect.label_confirmed)
    )
    plan = executed(chained.rows())
    assert plan.count("FileScan parquet") <= 6
