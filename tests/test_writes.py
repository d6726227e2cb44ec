from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.sources import writes

TEXT, NUMBER = T.StringType(), T.DoubleType()
SCHEMA = T.StructType().add("transaction_id", TEXT).add("amount", NUMBER).add("layer", TEXT)


@pytest.fixture
def table(spark, where):
    return writes.WrittenTable(spark, where, SCHEMA)


def rows(spark, *pairs):
    return spark.createDataFrame([(i, float(a), "silver") for i, a in pairs], SCHEMA)


def content(df):
    return sorted((str(r["transaction_id"]), r["amount"]) for r in df.collect())


def test_a_table_not_written_yet_is_empty(table):
    assert content(table.read()) == [] and table.keys().collect() == []
    assert writes.history(table.read()).collect() == []


def test_writes_add_up_and_a_repeated_one_replaces_itself(spark, table):
    table.write(rows(spark, ("a", 1), ("b", 1)), "w0")
    table.write(rows(spark, ("c", 3)), "w1")
    table.write(rows(spark, ("a", 2)), "w0")
    assert content(table.read()) == [("a", 2.0), ("c", 3.0)]
    told = [(r["write_id"], r["operation"], r["n_rows"]) for r in writes.history(table.read()).collect()]
    assert sorted(told) == [("w0", "write", 1), ("w1", "write", 1)]
    table.write(rows(spark), "w2")
    assert len(content(table.read())) == 2
    plan = table.written_by("w1")._jdf.queryExecution().executedPlan().toString()
    assert "write_id" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_insert_if_absent_twice_is_once(spark, table):
    for write, pairs in (("w0", [("a", 1), ("b", 1)]), ("w1", [("b", 2), ("c", 2)]), ("w2", [("b", 3), ("c", 3)])):
        table.insert_absent(rows(spark, *pairs), write)
    table.insert_absent(rows(spark, ("b", 2), ("c", 2)), "w1")  # replayed
    assert content(table.read()) == [("a", 1.0), ("b", 1.0), ("c", 2.0)]


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("sent_keys", [1_000_000, 0])
def test_an_insert_shuffles_no_stored_key(spark, where, sent_keys):
    table = writes.WrittenTable(spark, where, SCHEMA, sent_keys=sent_keys)
    many = spark.range(5_000).select(F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit(1.0).alias("amount"), F.lit("silver").alias("layer"))
    assert table.insert_absent(many, "w0") == 5_000
    assert table.insert_absent(many.limit(100), "w1") == 0
    batch = writes._hashed(rows(spark, ("t1", 1), ("new", 1), (None, 1), (None, 2)), "transaction_id")
    new = writes.absent(batch, table.keys(), "transaction_id", sent_keys)
    plan = plan_of(new)
    assert content(new) == [("None", 1.0), ("None", 2.0), ("new", 1.0)]
    assert "Bucketed: true" in plan or sent_keys
    above = [k for k, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line and "_hash" not in line]
    lines = plan.splitlines()
    scan = next(k for k, line in enumerate(lines) if "keys_" in line and "FileScan" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*(0123456789)"))
    ancestors = []
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if at < depth:
            ancestors.append(line)
            depth = at
    assert not any("Exchange hash" in line or "Exchange range" in line for line in ancestors), (above, plan)


def test_both_ways_of_inserting_agree(spark, where):
    loads = [[(f"t{k}", n) for k in range(n * 7, n * 7 + 20)] + [(None, n)] for n in range(4)]
    found = []
    for sent_keys in (1_000_000, 0):
        table = writes.WrittenTable(spark, f"{where}/{sent_keys}", SCHEMA, buckets=4, sent_keys=sent_keys)
        counts = [table.insert_absent(rows(spark, *load), f"w{n}") for n, load in enumerate(loads)]
        table.insert_absent(rows(spark, *loads[2]), "w2")  # replayed
        found.append((counts, content(table.read()), sorted(map(str, table.keys().collect()))))
    assert found[0] == found[1] and found[0][0] == [21, 7, 7, 7]


def test_keys_are_found_again_by_another_session(spark, where):
    table = writes.WrittenTable(spark, where, SCHEMA)
    table.insert_absent(rows(spark, ("a", 1)), "w0")
    spark.sql(f"DROP TABLE {table._key_table()}")  # only the catalog's entry: the files are not its own
    assert table.insert_absent(rows(spark, ("a", 2), ("b", 2)), "w1") == 1
    assert content(table.read()) == [("a", 1.0), ("b", 2.0)]


def test_rows_as_of_a_time_and_the_history(spark, table):
    day = [dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc) for n in range(1, 6)]
    table.write(rows(spark, ("a", 1)), "first", day[1])
    table.insert_absent(rows(spark, ("b", 2), ("c", 2)), "second", day[3])
    counts = [table.as_of(t).count() for t in day]
    assert counts == [0, 1, 1, 3, 3]
    told = [(r["write_id"], r["operation"], r["n_rows"]) for r in writes.history(table.read()).collect()]
    assert told == [("first", "write", 1), ("second", "insert", 2)]
    seen = writes.compare_writes(table.read(), {"early": day[2], "late": day[4], "second": ["second"]})
    assert {r["moment"]: r["total"] for r in seen.collect()} == {"early": 1, "late": 3, "second": 2}


def test_null_keys_are_one_key(spark, table):
    for write in ("w0", "w1"):
        table.insert_absent(rows(spark, (None, 1)), write)
    assert content(table.read()) == [("None", 1.0)]
    assert table.insert_absent(rows(spark, (None, 1), ("x", 1)), "w2") == 1


def test_a_write_with_a_violating_row_is_refused_whole(spark, where):
    table = writes.WrittenTable(spark, where, SCHEMA, {"amount_positive": F.col("amount") > 0})
    table.write(rows(spark, ("a", 1)), "w0")
    with pytest.raises(Exception, match="amount_positive"):
        table.write(rows(spark, ("b", 2), ("c", -3)), "w1")
    assert content(table.read()) == [("a", 1.0)]


def test_moments_read_the_rows_once(spark, table):
    for n in range(3):
        table.write(rows(spark, (f"t{n}", n)), f"w{n}")
    seen = writes.compare_writes(table.read(), {"first": ["w0"], "second": ["w0", "w1"], "now": None, "none": []})
    got = {r["moment"]: (r["total"], r["avg_amount"]) for r in seen.collect()}
    assert got == {"first": (1, 0.0), "second": (2, 1.0), "now": (3, 1.0)}


def test_gold_is_replaced_by_every_run(spark, where):
    from silverlane.plans.gold import replace_gold
    from tests.test_detect import frame

    silver = frame(spark, [("u", 10, "app", i) for i in range(8)])
    for most, alerts in (("5", 3), ("2", 6), ("", 3)):
        replace_gold(where, silver, {"max_tx": most})
        assert spark.read.parquet(where).where("alert").count() == alerts


def test_scratch_is_a_shared_folder():
    from silverlane.scratch import run_dir, shared_dir

    class Session:
        def __init__(self, **settings):
            self.conf = {k.replace("_", "."): v for k, v in settings.items()}

    named = Session(spark_checkpoint_dir="s3a://shared/ckpt/")
    assert shared_dir(named) == "s3a://shared/ckpt"
    assert run_dir(named, "x") != run_dir(named, "x")
    assert shared_dir(Session(spark_sql_warehouse_dir="hdfs://w/")) == "hdfs://w/_scratch"
