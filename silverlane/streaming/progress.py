"""What a stream did in each micro-batch, kept as a table: rows, rates and time taken, and how far it is behind.

The figures are those Spark reports anyway, so no batch runs a job more. They are gathered where the
query is driven and written some hundreds at a time; what is not yet written is lost with that process. File
sources report no backlog: it is what has landed less what the checkpoint says was taken.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import (
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryProgress,
)
from pyspark.sql.window import Window

from silverlane.sources.landing import read_if_present

PROGRESS = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("n_input", T.LongType()),
        T.StructField("rows_per_s", T.DoubleType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)
#: Batches that are written together.
FLUSH = 500


class ProgressLog(StreamingQueryListener):
    """A listener that keeps every batch's progress in a folder: `spark.streams.addListener(log)` before the query starts.

    A batch whose progress is reported twice, as after a restart, is there twice, under two run ids. Triggers
    that found nothing new report no rows and are kept too.
    """

    def __init__(self, spark: SparkSession, path: str, flush: int = FLUSH):
        self.spark, self.path, self._flush = spark, path, flush
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        row = progress_row(event.progress)
        with self._changed:
            self._rows.append(row)
            full = len(self._rows) >= self._flush
        if full:
            self.flush()

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait_for(self, query: StreamingQuery, timeout_s: float = 60) -> None:
        """Wait until everything a query that has ended reported has arrived, and write it. Reports come after the query ends."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, timeout_s):
                raise TimeoutError(f"no report that the query {query.runId} has ended within {timeout_s} s")
        self.flush()

    def flush(self) -> None:
        """Write what has been gathered; if that fails it is kept for the next time."""
        with self._changed:
            rows, self._rows = self._rows, []
        if not rows:
            return
        try:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
        except BaseException:
            with self._changed:
                self._rows = rows + self._rows
            raise

    def read(self) -> DataFrame:
        """All progress written so far."""
        return read_if_present(self.spark, self.spark.read.schema(PROGRESS).parquet, self.path, PROGRESS)


def progress_row(progress: StreamingQueryProgress) -> tuple:
    """One report as a row of the table."""
    started = dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    rate = progress.processedRowsPerSecond
    return (
        str(progress.id),
        str(progress.runId),
        progress.batchId,
        started,
        sum(source.numInputRows for source in progress.sources),
        None if rate is None else float(rate),
        progress.durationMs.get("triggerExecution"),
    )


LANDED = T.StructType([T.StructField("file", T.StringType()), T.StructField("bytes", T.LongType())])
TAKEN = T.StructType([T.StructField("path", T.StringType()), T.StructField("batchId", T.LongType())])


def _plain(path: Column) -> Column:
    """A path with one slash after its scheme, of which the checkpoint writes three for local files."""
    return F.regexp_replace(path, r"^(\w+):/+", "$1:/")


def backlog(spark: SparkSession, landing: str, checkpoint: str, pattern: str = "*.json") -> DataFrame:
    """(batch_id, n_files, n_bytes, files_left, bytes_left) of each batch: what it took of all that has landed by now, and what it left.

    Files that no batch has taken are left by all, and are a row of batch_id null. A file is listed, not opened.
    """
    lines = spark.read.schema("value string").text
    log = read_if_present(spark, lines, f"{checkpoint}/sources/0", T.StructType().add("value", T.StringType()))
    entry = F.from_json("value", TAKEN)
    taken = log.where(F.col("value").startswith("{")).select(_plain(entry["path"]).alias("file"), entry["batchId"].alias("batch_id")).distinct()
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    meta = F.col("_metadata")
    landed = read_if_present(
        spark, lambda path: files.load(path).select(_plain(meta["file_path"]).alias("file"), meta["file_size"].alias("bytes")), landing, LANDED
    )
    batches = landed.join(taken, "file", "left").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("n_bytes"))
    after = Window.orderBy(F.col("batch_id").asc_nulls_last()).rowsBetween(1, Window.unboundedFollowing)  # a row for each batch
    left = [F.coalesce(F.sum(n).over(after), F.lit(0)).alias(to) for n, to in (("n_files", "files_left"), ("n_bytes", "bytes_left"))]
    return batches.select("*", *left)
