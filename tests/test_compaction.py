from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from silverlane.sources import compaction


def least_bins(sizes, target):
    """The least number of bins, by trying everything."""
    best = len(sizes)

    def put(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[k]}:
            at = rooms.index(room)
            put(k + 1, rooms[:at] + [room - sizes[k]] + rooms[at + 1 :])
        put(k + 1, [*rooms, target - sizes[k]])

    put(0, [])
    return best


def first_fit_decreasing(sizes, target):
    rooms, bins = [], []
    for size in sorted(sizes, reverse=True):
        at = next((k for k, room in enumerate(rooms) if room >= size), len(rooms))
        if at == len(rooms):
            rooms.append(target)
        rooms[at] -= size
        bins.append(at)
    return bins


@pytest.fixture
def files(spark):
    def make(*by_layer):
        rows = [(layer, f"{layer}-{k:05d}", size) for layer, sizes in by_layer for k, size in enumerate(sizes)]
        return spark.createDataFrame(rows, "layer string, file string, size long")

    return make


def held(plan):
    bins = {}
    for row in plan.collect():
        bins.setdefault((row["layer"], row["bin"]), []).append(row["size"])
    return bins


def test_bins_are_those_of_first_fit_decreasing_and_near_the_least(files):
    dice = random.Random(3)
    lists = {f"l{k}": [dice.randint(1, 60) for _ in range(dice.randint(1, 9))] for k in range(20)}
    bins = held(compaction.compaction_plan(files(*lists.items()), target=100))
    for layer, sizes in lists.items():
        mine = {b: x for (at, b), x in bins.items() if at == layer}
        want = first_fit_decreasing(sizes, 100)
        assert len(mine) == max(want) + 1
        assert sorted(x for one in mine.values() for x in one) == sorted(sizes)
        assert all(sum(x) <= 100 for x in mine.values())
        assert 9 * len(mine) <= 11 * least_bins(sorted(sizes, reverse=True), 100) + 6
    assert sorted(b for _, b in bins) == list(range(len(bins)))  # without gaps over all layers


def test_a_file_over_the_target_is_alone_and_equal_sizes_are_all_placed(files):
    bins = held(compaction.compaction_plan(files(("a", [500, 10, 10, 10]), (None, [50] * 7)), target=100))
    assert sorted(bins.values()) == [[10, 10, 10], [50], [50, 50], [50, 50], [50, 50], [500]]


def test_a_partition_of_many_files_is_packed_in_parts(files):
    dice = random.Random(5)
    sizes = [dice.randint(1, 10) for _ in range(3_000)]
    plan = compaction.compaction_plan(files(("hot", sizes), ("cold", [7])), target=100, part_files=100)
    bins = held(plan)
    hot = [x for (layer, _), x in bins.items() if layer == "hot"]
    assert sum(map(len, hot)) == 3_000 and max(map(sum, hot)) <= 100
    assert len(hot) <= sum(sizes) / (100 - 10) + 30  # a bin that is not full for each of the 30 parts


def test_no_files_no_plan(files):
    assert compaction.compaction_plan(files(("a", [1])).limit(0)).collect() == []


def test_a_table_keeps_its_rows_and_has_a_file_for_each_bin(spark, where):
    rows = spark.range(4_000).select("id", F.when(F.col("id") % 3 > 0, F.lit("silver")).alias("layer"), F.lit(1).alias("bin"))
    rows.repartition(12).write.partitionBy("layer").parquet(f"{where}/old")
    before = compaction.stored_files(spark, f"{where}/old").collect()
    target = 4 * max(f["size"] for f in before)
    plan = compaction.compact(spark, f"{where}/old", f"{where}/new", target)
    after = compaction.stored_files(spark, f"{where}/new/rows")
    assert plan.count() == len(before) == 24
    assert after.count() == plan.select("bin").distinct().count() <= 8
    read = spark.read.parquet(f"{where}/new/rows").select("id", "layer", "bin")
    assert read.exceptAll(rows).isEmpty() and rows.exceptAll(read).isEmpty()
    compaction.compact(spark, f"{where}/old", f"{where}/new", target)  # once more, as after a failure
    assert spark.read.parquet(f"{where}/new/rows").count() == 4_000


def test_listing_reads_no_rows(spark, where):
    spark.range(10).withColumn("layer", F.lit("a")).write.partitionBy("layer").parquet(where)
    plan = compaction.stored_files(spark, where)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1]
