"""Fewer, larger files: which files of a stored table belong together, and the table rewritten so.

Files are packed into bins of a target size by first-fit decreasing, a fold over arrays of sizes. The files of
a partition are dealt by hash into parts of some hundreds, so a partition with a million files is not
one task, and each part is packed by itself; what that costs is one bin for each part that is not full. The plan
comes from listing alone, no row is read for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bytes of a bin, and files that are packed together on average.
TARGET_BYTES = 256 << 20
PART_FILES = 512


def stored_files(spark: SparkSession, path: str, partitions: Sequence[str] = ("layer",)) -> DataFrame:
    """(partitions, file, size) of every Parquet file, without opening one."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(*partitions, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))


def first_fit(sizes: Column, target: int) -> Column:
    """For each of an array of sizes the first bin, from 0, that still has room for it; a larger one than the target is alone."""

    def place(state: Column, size: Column) -> Column:
        found = F.array_position(F.transform(state["free"], lambda room: room >= size), True)
        opened = F.concat(state["free"], F.array(F.lit(target).cast("long") - size))

        def put(at: Column) -> Column:
            filled = F.transform(state["free"], lambda room, k: F.when(k + 1 == at, room - size).otherwise(room))
            bin_ = F.when(at == 0, F.size(state["free"])).otherwise((at - 1).cast("int"))
            return F.struct(
                F.when(at == 0, opened).otherwise(filled).alias("free"), F.concat(state["bins"], F.array(bin_)).alias("bins")
            )

        return F.get(F.transform(F.array(found), put), 0)  # so that the place is looked for once

    empty = F.struct(F.array().cast("array<bigint>").alias("free"), F.array().cast("array<int>").alias("bins"))
    return F.aggregate(sizes, empty, place, lambda state: state["bins"])


def compaction_plan(
    files: DataFrame,
    target: int = TARGET_BYTES,
    partitions: Sequence[str] = ("layer",),
    part_files: int = PART_FILES,
) -> DataFrame:
    """(partitions, file, size, bin) of stored files: those of one bin become one file. Bins are numbered from 0 without gaps.

    No bin is over the target, unless a single file is. Within a part, all bins but the last hold
    more than the target less the largest file among those after the first bin, as first fit does.
    """
    each = list(partitions)
    parts = files.groupBy(*each).agg(F.ceil(F.count(F.lit(1)) / part_files).alias("parts"))
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"p.{c}")) for c in each]
    dealt = files.alias("f").join(parts.alias("p"), same).select("f.*", F.pmod(F.xxhash64("file"), F.col("parts")).alias("part"))
    packed = (
        dealt.groupBy(*each, "part")
        .agg(F.sort_array(F.collect_list(F.struct("size", "file")), asc=False).alias("files"))  # some hundreds
        .withColumn("bins", first_fit(F.transform("files", lambda f: f["size"]), target))
        .withColumn("n_bins", F.array_max("bins") + 1)
    )
    # One number for each part before; a row for some hundreds of files.
    numbers = packed.select(*each, "part", "n_bins")
    before = Window.orderBy(*each, "part").rowsBetween(Window.unboundedPreceding, -1)
    first = numbers.withColumn("first", F.coalesce(F.sum("n_bins").over(before), F.lit(0))).drop("n_bins")
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"n.{c}")) for c in [*each, "part"]]
    return (
        packed.alias("b")
        .join(first.alias("n"), same)
        .select(*[f"b.{c}" for c in each], "first", F.explode(F.arrays_zip("files", "bins")).alias("one"))
        .select(*each, "one.files.file", "one.files.size", (F.col("first") + F.col("one.bins")).cast("int").alias("bin"))
    )


def compact(
    spark: SparkSession,
    path: str,
    folder: str,
    target: int = TARGET_BYTES,
    partitions: Sequence[str] = ("layer",),
    part_files: int = PART_FILES,
) -> DataFrame:
    """The table rewritten to another folder as one write, a file for each bin; the plan it went by.

    Rows cross the network once. The old files stay, so a rewrite that died is just done again. Null
    partitions stay null, and files without rows are not written again.
    """
    plan = compaction_plan(stored_files(spark, path, partitions), target, partitions, part_files)
    kept = f"{folder}/plan"
    plan.write.mode("overwrite").parquet(kept)  # both the rewrite and the caller go by the same numbers
    plan = spark.read.parquet(kept)
    n_bins = (plan.agg(F.max("bin").alias("last")).first().last or 0) + 1
    rows = spark.read.parquet(path)
    columns = rows.columns
    placed = rows.withColumn("_file", F.col("_metadata.file_path")).join(
        plan.select(F.col("file").alias("_file"), F.col("bin").alias("_bin")), "_file"
    )
    dealt = placed.repartitionById(n_bins, F.col("_bin")).select(columns)
    dealt.write.mode("overwrite").partitionBy(*partitions).parquet(f"{folder}/rows")
    return plan
