"""Where a job may put files that every executor must be able to read."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`, else one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def run_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, so that runs never meet."""
    return f"{shared_dir(spark)}/silverlane/{name}-{uuid.uuid4().hex}"
