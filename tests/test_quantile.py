from __future__ import annotations

import math
import random

import numpy as np
import pytest

from silverlane.operators.quantile import exact_percentiles
from silverlane.operators.skew import Share

WANTED = {"lowest": 0.0, "third": 1 / 3, "median": 0.5, "p95": 0.95, "highest": 1.0}


def data(kind: str) -> list[float]:
    rnd = random.Random(7)
    return {
        "one": [4.5],
        "two": [1.0, 2.0],
        "constant": [3.25] * 500,
        "money": [round(rnd.lognormvariate(11, 1.1), 2) for _ in range(3_000)],
        "signed": [rnd.gauss(0, 100) for _ in range(2_001)] + [0.0, -0.0],
        "spread": [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-300, 300) for _ in range(1_500)],
        "close": [1.0 + i * 2**-52 for i in range(700)],
        "heavy": [7.0] * 900 + [rnd.uniform(6.999, 7.001) for _ in range(800)],
    }[kind]


@pytest.mark.parametrize("share", [Share(), Share(min_rows=0, max_keys=1_000)])
def test_percentiles_equal_numpy(spark, share):
    kinds = ["one", "two", "constant", "money", "signed", "spread", "close", "heavy"]
    rows = [(k, v) for k in kinds for v in data(k)] + [(None, 1.0), (None, 9.0), ("money", None)]
    df = spark.createDataFrame(rows, "kind string, value double")
    got = {r["kind"]: r for r in exact_percentiles(df, "kind", "value", WANTED, share).collect()}
    assert set(got) == {*kinds, None}
    for kind in kinds:
        for name, p in WANTED.items():
            expected = float(np.quantile(np.array(data(kind)), p))
            assert got[kind][name] == pytest.approx(expected, rel=1e-12, abs=1e-300), (kind, name)
    assert got[None]["median"] == 5.0


def test_special_values_sort_as_in_spark(spark):
    values = [float("-inf"), -1.0, 0.0, 1.0, float("inf"), float("nan"), float("nan")]
    df = spark.createDataFrame([("g", v) for v in values], "kind string, value double")
    wanted = {"low": 0.0, "mid": 0.5, "top": 1.0}
    a, b = (
        exact_percentiles(df, "kind", "value", wanted, share).first()
        for share in (Share(), Share(min_rows=0, max_keys=10))
    )
    assert a["low"] == b["low"] == float("-inf")
    assert a["mid"] == b["mid"] == 1.0
    assert math.isnan(a["top"]) and math.isnan(b["top"])
