from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverlane.operators import quality
from silverlane.schema import RAW

GOOD = ("t1", "u1", 10.0, "app", "c", "d", "2024-01-01T00:00:00")


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def changed(**values):
    row = dict(zip(RAW.names, GOOD)) | values
    return tuple(row[n] for n in RAW.names)


def ids(df):
    return sorted(r["transaction_id"] for r in df.collect())


def test_rows_that_break_a_rule_are_refused(spark):
    df = raw(
        spark,
        GOOD,
        changed(transaction_id="null", amount=None),
        changed(transaction_id="zero", amount=0.0),
        changed(transaction_id="minus", amount=-1.0),
        changed(transaction_id="chan", channel="pigeon"),
        changed(transaction_id="nochan", channel=None),
        changed(transaction_id="ts", ts="yesterday"),
        changed(transaction_id="nots", ts=None),
        changed(transaction_id=None),
        changed(transaction_id="nouser", user_id=None),
        changed(transaction_id="later", ts="2612-05-04T00:00:00"),
    )
    assert ids(quality.clean(df)) == ["t1"]
    assert ids(quality.clean(df, on_bad_ts="keep")) == ["nots", "t1", "ts"]
    counts = {r["reason"]: r["n"] for r in quality.reject_reasons(df).collect()}
    assert counts == {
        "no_id": 1,
        "no_user": 1,
        "bad_amount": 3,
        "bad_channel": 2,
        "bad_ts": 2,
        "future_ts": 1,
        "duplicate": 0,
    }
    early = F.lit("2023-01-01").cast("timestamp")
    assert ids(quality.clean(df, as_of=early)) == []
    assert "chan" in ids(quality.clean(df, channels=("app", "pigeon")))
    report = quality.quality_report(df).first()
    assert (report["n_bronze"], report["n_silver"], report["n_rejected"]) == (11, 1, 10)
    assert report["pct_rejected"] == 90.9


def test_unknown_mode_is_an_error(spark):
    with pytest.raises(ValueError):
        quality.clean(raw(spark, GOOD), on_bad_ts="ignore")


def test_one_copy_survives_and_it_is_the_earliest_valid_one(spark):
    df = raw(
        spark,
        changed(amount=-5.0, ts="2023-12-31T00:00:00"),  # earlier, but invalid
        changed(amount=30.0, ts="2024-01-02T00:00:00"),
        changed(amount=20.0),
        changed(amount=15.0),
        changed(amount=1.0, ts="never"),
    )
    strict = quality.clean(df).collect()
    assert [(r["amount"], str(r["ts"])[:10]) for r in strict] == [(15.0, "2024-01-01")]
    kept = quality.clean(df, on_bad_ts="keep").collect()
    assert [r["amount"] for r in kept] == [15.0]  # an unknown time comes last


def test_rows_without_a_key_are_refused(spark):
    df = raw(spark, changed(transaction_id=None), changed(transaction_id=None, amount=5.0))
    assert quality.clean(df).count() == 0
    assert quality.quality_report(df).first()["n_silver"] == 0


def test_many_copies_of_one_key_are_combined_before_the_shuffle(spark):
    df = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("ts"),
    )
    kept = quality.first_copy(df, "k", "ts")
    assert kept.count() == 66_667
    assert kept.where("k = 'same'").first()["ts"] == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_empty_input(spark):
    df = raw(spark)
    assert quality.clean(df).count() == 0
    report = quality.quality_report(df).first()
    assert (report["n_bronze"], report["n_rejected"], report["pct_rejected"]) == (0, 0, 0.0)


def typed(spark, *rows):
    return raw(spark, *rows).withColumn("ts", F.col("ts").try_cast("timestamp"))


@pytest.mark.parametrize(
    "bad, name",
    [
        ({"amount": -0.25}, "amount_positive"),
        ({"amount": None}, "amount_positive"),
        ({"channel": "pigeon"}, "channel_valid"),
        ({"ts": "2612-05-04T00:00:00"}, "ts_not_future"),
        ({"user_id": None}, "user_id_present"),
        ({"transaction_id": None}, "transaction_id_present"),
    ],
)
def test_a_violating_row_refuses_the_whole_write(spark, where, bad, name):
    good = typed(spark, GOOD)
    quality.enforce(good).write.parquet(where)
    both = typed(spark, GOOD, changed(**({"ts": "2023-11-05T17:20:00"} | bad)))
    with pytest.raises(Exception, match=name):
        quality.enforce(both).write.mode("append").parquet(where)
    assert spark.read.parquet(where).count() == 1
    found = {r["constraint"]: r["violations"] for r in quality.constraint_violations(both).collect()}
    assert {n for n, v in found.items() if v} == {name}


def test_layer_comparison_may_be_negative(spark):
    few, many = raw(spark, GOOD), raw(spark, GOOD, changed(transaction_id="t2"))
    row = quality.compare_layers(few, many).first()
    assert (row["n_rejected"], row["pct_rejected"]) == (-1, -100.0)
    assert quality.compare_layers(raw(spark), raw(spark)).first()["pct_rejected"] == 0.0


TIMES = ["2024-01-01T00:00:00", "2024-01-02T00:00:00", "soon", None]
random_row = st.tuples(
    st.sampled_from(["a", "b", "c", None]),
    st.just("u"),
    st.sampled_from([None, -1.0, 0.0, 1.0, 2.0]),
    st.sampled_from(["app", "qr", "fax", None]),
    st.sampled_from(["x", "y", None]),
    st.just("d"),
    st.sampled_from(TIMES),
)


@settings(max_examples=8, derandomize=True, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(random_row, max_size=25))
def test_clean_equals_the_plain_computation(spark, rows):
    def readable(ts):
        return ts if ts and ts[0] == "2" else None

    def order(row):  # a missing time last, other missing values first
        _, _, amount, channel, city, _, ts = row
        return (readable(ts) is None, readable(ts) or "", amount, channel, city is not None, city or "")

    for mode in ("reject", "keep"):
        valid = [
            r for r in rows
            if r[0] is not None and r[2] is not None and r[2] > 0 and r[3] in ("app", "qr", "corresponsal", "api")
            and (mode == "keep" or readable(r[6]))
        ]
        kept = {}
        for row in sorted(valid, key=order, reverse=True):
            kept[row[0]] = row
        got = quality.clean(raw(spark, *rows), mode).collect()
        assert len(got) == len(kept)
        for g in got:
            row = kept[g["transaction_id"]]
            assert (g["amount"], g["channel"], g["city"]) == (row[2], row[3], row[4])
            seen = None if g["ts"] is None else g["ts"].strftime("%Y-%m-%dT%H:%M:%S")
            assert seen == readable(row[6])
