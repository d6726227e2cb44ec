from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from silverlane.operators import compat

CASES = [
    ("int", "int", "same"),
    ("int", "bigint", "widened"),
    ("bigint", "int", "narrowed"),
    ("int", "double", "widened"),
    ("bigint", "double", "narrowed"),
    ("smallint", "float", "widened"),
    ("int", "float", "narrowed"),
    ("float", "double", "widened"),
    ("double", "float", "narrowed"),
    ("double", "decimal(38,10)", "narrowed"),
    ("decimal(10,2)", "decimal(12,2)", "widened"),
    ("decimal(10,2)", "decimal(11,4)", "narrowed"),
    ("decimal(10,2)", "decimal(9,2)", "narrowed"),
    ("decimal(9,0)", "int", "widened"),
    ("decimal(10,0)", "int", "narrowed"),
    ("decimal(15,0)", "double", "widened"),
    ("decimal(16,0)", "double", "narrowed"),
    ("decimal(5,2)", "double", "narrowed"),
    ("bigint", "decimal(19,0)", "widened"),
    ("bigint", "decimal(20,2)", "narrowed"),
    ("boolean", "string", "widened"),
    ("string", "int", "narrowed"),
    ("string", "binary", "lost"),
    ("binary", "string", "lost"),
    ("boolean", "int", "lost"),
    ("date", "timestamp", "widened"),
    ("timestamp", "date", "narrowed"),
    ("int", "date", "lost"),
    ("struct<a: int>", "string", "lost"),
    ("array<int>", "int", "lost"),
]


@pytest.mark.parametrize("old, new, verdict", CASES)
def test_verdicts(spark, old, new, verdict):
    one = [T._parse_datatype_string(f"x {kind}") for kind in (old, new)]
    assert [(c.path, c.verdict) for c in compat.compare_types(*one)] == [("x", verdict)]
    assert compat.compatible(*one) == (verdict in ("same", "widened"))


def test_paths_through_nested_types(spark):
    old = "a struct<b: array<struct<c: int, gone: string>>, m: map<int, array<double>>>, `odd.name` int"
    new = "a struct<b: array<struct<c: bigint, fresh: date>>, m: map<bigint, array<int>>>, `odd.name` int, top string"
    found = compat.compare_types(*(T._parse_datatype_string(x) for x in (old, new)))
    assert {c.path: c.verdict for c in found} == {
        "a.b[].c": "widened",
        "a.b[].gone": "lost",
        "a.b[].fresh": "added",
        "a.m{key}": "widened",
        "a.m{value}[]": "narrowed",
        "odd.name": "same",
        "top": "added",
    }


def test_values_that_would_not_survive(spark):
    schema = T._parse_datatype_string(
        "n bigint, x double, s string, t timestamp_ntz, a array<struct<v: double>>, m map<string, array<bigint>>, "
        "`odd.name` string, gone struct<k: int>"
    )
    noon, midnight = dt.datetime(2024, 1, 2, 12), dt.datetime(2024, 1, 2)
    rows = [
        (1, 1.0, "12", midnight, [(1.0,), (1.5,), None, (None,)], {"a": [1, 2**40], "7": None}, "x", (1,)),
        (2**31, float("nan"), "twelve", noon, [], {}, "5", None),
        (None, 0.5, "", None, None, None, None, (None,)),
        (-(2**31), -0.0, None, noon, [(2.25,)], {"b": [2**31 - 1, None]}, "1.5", (2,)),
    ]
    new = T._parse_datatype_string(
        "n int, x bigint, s int, t date, a array<struct<v: bigint>>, m map<int, array<int>>, `odd.name` double, fresh int"
    )
    got = {r["path"]: (r["verdict"], r["n_values"], r["n_lost"]) for r in compat.compatibility(spark.createDataFrame(rows, schema), new).collect()}
    assert got == {
        "n": ("narrowed", 3, 1),
        "x": ("narrowed", 4, 2),
        "s": ("narrowed", 3, 2),
        "t": ("narrowed", 3, 2),
        "a[].v": ("narrowed", 3, 2),
        "m{key}": ("narrowed", 3, 2),
        "m{value}[]": ("narrowed", 3, 1),
        "odd.name": ("narrowed", 3, 1),
        "gone": ("lost", 3, 3),
        "fresh": ("added", 0, 0),
    }


def test_no_rows(spark):
    empty = spark.createDataFrame([], "a array<int>, b int")
    new = T._parse_datatype_string("a array<tinyint>")
    found = compat.compatibility(empty, new).collect()
    assert [(r["path"], r["verdict"], r["n_values"], r["n_lost"]) for r in found] == [("a[]", "narrowed", 0, 0), ("b", "lost", 0, 0)]
