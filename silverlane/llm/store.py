"""Small helpers shared by the operators: picking columns, and tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """These columns under new names (new=old), found by exact name.

    Other columns may have any name, also one that differs in case only or repeats: of two
    columns with exactly the wanted name the first counts.
    """
    places = {name: k for k, name in reversed(list(enumerate(df.columns)))}
    missing = [old for old in wanted.values() if old not in places]
    if missing:
        raise ValueError(f"no column {missing} in {df.columns}")
    numbered = df.toDF(*[f"_{k}" for k in range(len(df.columns))])
    return numbered.select(*[F.col(f"_{places[old]}").alias(new) for new, old in wanted.items()])


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir, else one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return named.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder: a lost executor costs no second run."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
