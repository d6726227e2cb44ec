"""Counts and bounds of a stored table from its Parquet footers, and its files from their metadata columns.

Only the V2 reader hands aggregates down to the footers. It is switched on in a session of its own, so the
caller's settings stay as they are; what comes back is a few rows for each layer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster that reads Parquet with aggregates pushed into the footers."""
    own = spark.newSession()
    v1 = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def footer_aggregate(spark: SparkSession, path: str, columns: Sequence[str], partition: str = "layer") -> DataFrame:
    """(partition, n_rows, min and max of these columns) of a table partitioned by one column, from footers alone.

    The columns must be numbers or dates: Parquet has no exact bounds of texts, nor of Spark's times. The
    result belongs to the session of its own.
    """
    held = footer_session(spark).read.parquet(path)
    bounds = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return held.groupBy(partition).agg(F.count(F.lit(1)).alias("n_rows"), *bounds)


def file_stats(spark: SparkSession, path: str, partition: str = "layer") -> DataFrame:
    """(partition, n_files, total_bytes, last_modified): no column of the rows is read.

    Files without rows are not seen.
    """
    meta = F.col("_metadata")
    files = spark.read.parquet(path).select(
        partition, meta["file_path"].alias("file"), meta["file_size"].alias("size"), meta["file_modification_time"].alias("at")
    )
    one = files.groupBy(partition, "file").agg(F.first("size").alias("size"), F.first("at").alias("at"))
    return one.groupBy(partition).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("total_bytes"), F.max("at").alias("last_modified")
    )


def layer_file_stats(spark: SparkSession, path: str, columns: Sequence[str], partition: str = "layer") -> DataFrame:
    """Both of the above in one row for each partition."""
    footers = footer_aggregate(spark, path, columns, partition)
    known = spark.createDataFrame(footers.collect(), footers.schema)  # a row for each partition
    return known.join(file_stats(spark, path, partition), partition)
