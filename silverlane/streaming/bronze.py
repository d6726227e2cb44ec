"""Landed files -> Bronze by micro-batch, with a schema that grows with what lands."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlane.sources.evolving import EvolvingTable
from silverlane.sources.landing import LINE, MAX_FILES_PER_TRIGGER
from silverlane.streaming.silver import QUERY_ID


def run_bronze(
    spark: SparkSession,
    path: str,
    table: EvolvingTable,
    checkpoint: str,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> None:
    """Take in everything that has landed so far, then return.

    The stream itself is of lines, so it need not be started anew when a field appears. A batch that is
    replayed after a crash replaces what it wrote before.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        batch.persist(StorageLevel.MEMORY_AND_DISK)  # read for its types, then for its rows
        try:
            table.take(batch, f"{query_id}-{batch_id}")
        finally:
            batch.unpersist()

    lines = spark.readStream.schema(LINE).format("text").option("maxFilesPerTrigger", max_files_per_trigger)
    shown = lines.load(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    started = shown.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
