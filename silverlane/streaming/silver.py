"""Bronze to Silver by micro-batch, each transaction written exactly once.

Copies are removed twice: within a batch by the quality rules, between batches by inserting
only absent keys. A batch is one write whose id is made of query id and batch id. Both stay the same
when a query restarts from its checkpoint, so a batch that is replayed after a crash replaces what
it wrote before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from silverlane.operators.quality import clean
from silverlane.schema import VALID_CHANNELS
from silverlane.sources.landing import read_if_present
from silverlane.sources.writes import WRITE_ID, WrittenTable

QUERY_ID = "sql.streaming.queryId"
METRICS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_raw", "n_valid", "n_rejected", "n_inserted")]
    + [T.StructField(WRITE_ID, T.StringType())]
)


def write_batch(
    batch: DataFrame,
    write_id: str,
    table: WrittenTable,
    channels: Sequence[str] = VALID_CHANNELS,
    as_of: Column | None = None,
) -> None:
    """Validate one batch, insert what Silver does not hold yet, and note how many rows there were."""
    seen = Observation()
    counted = batch.observe(seen, F.count(F.lit(1)).alias("n_raw"))
    valid = clean(counted, channels=channels, as_of=as_of).withColumn("layer", F.lit("silver"))
    # Counted, then written. If an executor is lost, its part is made again from the files.
    valid.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_valid = valid.count()
        n_raw = seen.get["n_raw"]  # from the job that counted the valid rows
        n_inserted = table.insert_absent(valid, write_id) if n_valid else 0
    finally:
        valid.unpersist()
    if not n_raw:
        return
    row = (n_raw, n_valid, n_raw - n_valid, n_inserted, write_id)
    one = batch.sparkSession.createDataFrame([row], METRICS).coalesce(1)
    one.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WRITE_ID).parquet(
        f"{table.root}/batches"
    )


def batch_metrics(table: WrittenTable) -> DataFrame:
    """Per micro-batch: rows read, valid after copies were removed, refused, and inserted."""
    path, reader = f"{table.root}/batches", table.spark.read.schema(METRICS)
    return read_if_present(table.spark, reader.parquet, path, METRICS).select(METRICS.names)


def start_silver(
    bronze: DataFrame,
    table: WrittenTable,
    checkpoint: str,
    processing_time: str | None = None,
    channels: Sequence[str] = VALID_CHANNELS,
    as_of: Column | None = None,
) -> StreamingQuery:
    """Start the stream: read what is there and stop, or go on at an interval."""

    def each(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        write_batch(batch, f"{query_id}-{batch_id}", table, channels, as_of)

    trigger = {"availableNow": True} if processing_time is None else {"processingTime": processing_time}
    return (
        bronze.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_silver(
    bronze: DataFrame,
    table: WrittenTable,
    checkpoint: str,
    channels: Sequence[str] = VALID_CHANNELS,
    as_of: Column | None = None,
) -> None:
    """Take in everything that has landed so far, then return."""
    start_silver(bronze, table, checkpoint, channels=channels, as_of=as_of).awaitTermination()
