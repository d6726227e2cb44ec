"""Catalog tables partitioned by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def layer_scan(spark: SparkSession, table: str, layer: str) -> DataFrame:
    """Rows of one layer; only that partition is read."""
    return spark.table(table).where(F.col("layer") == layer)


def overwrite_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a table and its schema, partitioned by layer."""
    writer = df.write.mode("overwrite").format("parquet").partitionBy("layer")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    """Append rows; columns are matched by name."""
    df.write.mode("append").format("parquet").partitionBy("layer").saveAsTable(table)


def physical_detail(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per partition folder of a table, without reading the contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return (
        files.option("recursiveFileLookup", "true")
        .load(path)
        .groupBy(F.regexp_extract("path", r"layer=([^/]+)", 1).alias("layer"))
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("total_bytes"),
            F.max("modificationTime").alias("last_modified"),
        )
        .orderBy("layer")
    )
