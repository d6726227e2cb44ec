from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.sources import evolving
from silverlane.sources.evolving import EvolvingTable, merged
from silverlane.streaming.bronze import run_bronze


def lines(spark, *found):
    text = [(x if isinstance(x, str) else json.dumps(x), "f") for x in found]
    return spark.createDataFrame(text, "value string, source_file string")


def kinds(table):
    return {f.name: f.dataType.simpleString() for f in table.schemas()[max(table.schemas())].fields}


LONG, DOUBLE, TEXT, FLAG = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
STRUCT, LIST = T.StructType([T.StructField("a", LONG)]), T.ArrayType(LONG)


@pytest.mark.parametrize("old, new, wanted", [
    (LONG, LONG, LONG), (LONG, DOUBLE, DOUBLE), (DOUBLE, LONG, DOUBLE), (LONG, TEXT, TEXT), (FLAG, LONG, TEXT),
    (TEXT, DOUBLE, TEXT), (STRUCT, LONG, STRUCT), (LIST, STRUCT, LIST), (LONG, STRUCT, TEXT),
    (LIST, T.ArrayType(DOUBLE), T.ArrayType(DOUBLE)),
    (STRUCT, T.StructType([T.StructField("b", TEXT), T.StructField("a", DOUBLE)]), T.StructType([T.StructField("a", DOUBLE), T.StructField("b", TEXT)])),
])
def test_types_form_a_lattice(old, new, wanted):
    assert merged(old, new) == wanted
    assert merged(wanted, old) == wanted and merged(wanted, new) == wanted and merged(wanted, wanted) == wanted


def test_fields_appear_and_widen(spark, where):
    table = EvolvingTable(spark, where)
    assert table.read().collect() == [] and table.changes().collect() == []
    assert table.take(lines(spark, {"id": 1, "n": 5, "at": {"x": 1}, "tags": [1], "empty": None, "nothing": {}}), "w0") == 1
    assert table.take(lines(spark, {"id": 2, "n": 6}), "w1") == 1
    assert table.take(lines(spark, {"id": 3, "n": 0.5, "at": {"x": 2.5, "y": "q"}, "tags": [1.5, None], "new": True}), "w2") == 2
    assert table.take(lines(spark, {"id": 4, "n": "six", "new": 1, "empty": 3, "a b'c": "odd name"}, "[1", "", "7"), "w3") == 3
    assert kinds(table) == {
        "at": "struct<x:double,y:string>", "id": "bigint", "n": "string", "tags": "array<double>",
        "new": "string", "a b'c": "string", "empty": "bigint",
    }
    rows = {r["id"]: r.asDict(recursive=True) for r in table.read().collect() if r["id"]}
    assert rows[1] | {"ingested_at": 0} == {
        "id": 1, "n": "5", "at": {"x": 1.0, "y": None}, "tags": [1.0], "new": None, "empty": None, "a b'c": None,
        "_corrupt_record": None, "_other_fields": '{"nothing":"{}"}', "source_file": "f", "ingested_at": 0, "schema_version": 1, "write_id": "w0"}
    assert rows[3]["at"] == {"x": 2.5, "y": "q"} and rows[3]["tags"] == [1.5, None] and rows[3]["new"] == "true"
    assert rows[2]["at"] is None and rows[4]["a b'c"] == "odd name" and rows[4]["n"] == "six"
    broken = [r["_corrupt_record"] for r in table.read().collect() if r["id"] is None]
    assert sorted(broken) == ["7", "[1"]
    earlier = table.read(2)
    assert earlier.schema["n"].dataType == DOUBLE and sorted(r["id"] for r in earlier.collect()) == [1, 2, 3]
    new = {(r["version"], r["column"]) for r in table.changes().collect()}
    assert (1, "new") not in new and (2, "new") in new


def test_what_does_not_fit_is_kept_aside(spark, where):
    table = EvolvingTable(spark, where)
    table.take(lines(spark, {"id": 1, "at": {"x": 1}, "list": [1]}), "w0")
    again = {"id": 2, "at": "here", "list": {"k": 1}, "ID": "other case", "write_id": "mine", "source_file": 3}
    assert table.take(lines(spark, again), "w1") == 1
    row = table.read().where("id = 2").first()
    assert row["at"] is None and row["list"] is None and row["write_id"] == "w1"
    kept = json.loads(row["_other_fields"])
    assert kept == {"at": "here", "list": '{"k":1}', "ID": "other case", "write_id": "mine", "source_file": "3"}
    assert table.read().where("id = 1").first()["_other_fields"] is None


def test_a_write_that_died_after_its_schema_is_repeated(spark, where, monkeypatch):
    table = EvolvingTable(spark, where)
    table.take(lines(spark, {"id": 1}), "w0")
    with monkeypatch.context() as patched:
        patched.setattr(evolving, "typed", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.take(lines(spark, {"id": 2, "more": 1}), "w1")
    assert max(table.schemas()) == 2 and table.read().count() == 1
    for _ in range(2):
        assert table.take(lines(spark, {"id": 2, "more": 1}), "w1") == 2
    assert sorted((r["id"], r["more"]) for r in table.read().collect()) == [(1, None), (2, 1)]


def test_types_are_combined_before_the_shuffle(spark, where):
    many = spark.range(0, 5_000, 1, 8).select(F.to_json(F.struct("id")).alias("value"), F.lit("f").alias("source_file"))
    counted = many.select(F.try_parse_json("value").alias("line")).agg(F.schema_of_variant_agg("line"))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_schema_of_variant_agg") == 1


def test_a_stream_need_not_be_started_anew(spark, where):
    table = EvolvingTable(spark, f"{where}/bronze")
    for rows in (['{"id": 1}'], ['{"id": 2, "x": 1}'], ['{"id": 3, "x": 1.5}']):
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(f"{where}/in")
    run_bronze(spark, f"{where}/in", table, f"{where}/ckpt", max_files_per_trigger=1)
    run_bronze(spark, f"{where}/in", table, f"{where}/ckpt")
    assert sorted((r["id"], r["x"]) for r in table.read().collect()) == [(1, None), (2, 1.0), (3, 1.5)]
    assert kinds(table)["x"] == "double" and table.read().where("source_file is null").count() == 0
