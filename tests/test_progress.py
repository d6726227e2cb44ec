from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from silverlane.functions.rules import table_constraints
from silverlane.schema import TRANSACTION
from silverlane.sources import landing, writes
from silverlane.streaming.progress import PROGRESS, ProgressLog, backlog
from silverlane.streaming.silver import batch_metrics, start_silver

LINES = "transaction_id string, user_id string, amount double, channel string, city string, device string, ts string"


def land(spark, path, first, n):
    rows = [(f"t{k}", "u", 1.0, "app", "c", "d", "2024-01-01 00:00:00") for k in range(first, first + n)]
    landing.land(spark.createDataFrame(rows, LINES).coalesce(1), path)


@pytest.fixture
def run(spark, where):
    def go(log):
        table = writes.WrittenTable(spark, f"{where}/silver", TRANSACTION, table_constraints())
        spark.streams.addListener(log)
        try:
            query = start_silver(landing.stream_landing(spark, f"{where}/in", max_files_per_trigger=1), table, f"{where}/checkpoint")
            query.awaitTermination()
            log.wait_for(query)
        finally:
            spark.streams.removeListener(log)
        return table

    return go


@pytest.mark.parametrize("flush", [1, 2, 500])
def test_every_batch_is_kept_once_and_agrees_with_its_own_counts(spark, where, run, flush):
    log = ProgressLog(spark, f"{where}/progress", flush)
    assert log.read().collect() == [] and log.read().schema == PROGRESS
    for k in range(3):
        land(spark, f"{where}/in", 10 * k, 4 + k)
    table = run(log)
    land(spark, f"{where}/in", 100, 3)
    run(log)  # goes on from the checkpoint
    kept = log.read().where("n_input > 0").orderBy("batch_id").collect()
    counted = batch_metrics(table).withColumn("batch_id", F.regexp_extract("write_id", r"-(\d+)$", 1).cast("long"))
    assert [(r["batch_id"], r["n_input"]) for r in kept] == [(r["batch_id"], r["n_raw"]) for r in counted.orderBy("batch_id").collect()]
    assert len({r["query_id"] for r in kept}) == 1 and len({r["run_id"] for r in kept}) == 2
    assert all(r["duration_ms"] > 0 and r["rows_per_s"] > 0 and r["started_at"] is not None for r in kept)
    files = spark.read.parquet(f"{where}/progress").select("_metadata.file_path").distinct().count()
    assert files >= 2 if flush > 1 else files >= len(kept)


def test_what_could_not_be_written_is_kept(spark, where):
    log = ProgressLog(spark, f"{where}/progress")
    log._rows.append(("q", "r", 0, None, 5, 1.0, 7))
    path, log.path = log.path, "nosuch://place"
    with pytest.raises(Exception):
        log.flush()
    log.path = path
    log.flush()
    assert log.read().select("n_input").collect()[0][0] == 5


def test_waiting_ends(spark, where):
    class Never:
        runId = "none"

    with pytest.raises(TimeoutError):
        ProgressLog(spark, where).wait_for(Never(), timeout_s=0.1)


def test_backlog_is_what_has_landed_and_was_not_taken(spark, where, run):
    assert backlog(spark, f"{where}/in", f"{where}/checkpoint").collect() == []
    for k in range(3):
        land(spark, f"{where}/in", 10 * k, 2)
    run(ProgressLog(spark, f"{where}/progress"))
    done = backlog(spark, f"{where}/in", f"{where}/checkpoint").orderBy("batch_id").collect()
    assert [(r["batch_id"], r["n_files"], r["files_left"]) for r in done] == [(0, 1, 2), (1, 1, 1), (2, 1, 0)]
    land(spark, f"{where}/in", 100, 5)
    late = {r["batch_id"]: r for r in backlog(spark, f"{where}/in", f"{where}/checkpoint").collect()}
    assert [late[b]["files_left"] for b in (0, 1, 2, None)] == [3, 2, 1, 0]
    assert late[None]["n_files"] == 1 and late[2]["bytes_left"] == late[None]["n_bytes"] > 0
