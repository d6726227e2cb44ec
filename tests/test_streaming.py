from __future__ import annotations

import json

import pytest

from silverlane.schema import TRANSACTION
from silverlane.functions.rules import table_constraints
from silverlane.sources import landing
from silverlane.sources.writes import WRITE_ID, WrittenTable
from silverlane.streaming import silver


def land(spark, path, *rows):
    """Each call adds one file; a row is (id, amount[, channel[, ts]])."""
    lines = []
    for row in rows:
        if isinstance(row, str):
            lines.append((row,))
            continue
        tid, amount, channel, ts = (*row, "app", "2024-01-01T00:00:00")[:4] if len(row) == 2 else row
        lines.append((json.dumps({
            "transaction_id": tid, "user_id": "u", "amount": amount, "channel": channel,
            "city": "c", "device": "d", "ts": ts}),))
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)


@pytest.fixture
def world(spark, where):
    return f"{where}/landing", WrittenTable(spark, f"{where}/silver", TRANSACTION, table_constraints()), f"{where}/ckpt"


def stored(table):
    return sorted((r["transaction_id"], r["amount"]) for r in table.read().collect())


def run(spark, world, files=1, checkpoint=""):
    path, table, ckpt = world
    silver.run_silver(landing.stream_landing(spark, path, max_files_per_trigger=files), table, ckpt + checkpoint)


def test_batches_are_deduplicated_within_and_between(spark, world):
    path, table, _ = world
    land(spark, path, ("a", 1.0), ("a", 1.0), ("bad", -1.0))
    land(spark, path, ("a", 7.0), ("b", 2.0), ("x", 1.0, "pigeon", "2024-01-01T00:00:00"))
    run(spark, world)
    ids = [i for i, _ in stored(table)]
    assert ids == ["a", "b"]
    metrics = silver.batch_metrics(table).collect()
    assert sum(m["n_raw"] for m in metrics) == 6
    assert sorted(m["n_valid"] for m in metrics) == [1, 2]
    assert sum(m["n_inserted"] for m in metrics) == 2
    assert sum(m["n_rejected"] for m in metrics) == 3
    lineage = table.read().first()
    assert lineage["source_file"].endswith(".txt") and lineage["ingested_at"] and not lineage["is_fraud"]

    run(spark, world)  # nothing new
    assert silver.batch_metrics(table).count() == len(metrics)
    land(spark, path, ("c", 3.0), ("b", 9.0))
    run(spark, world)
    assert stored(table)[1:] == [("b", 2.0), ("c", 3.0)]


def test_a_new_checkpoint_reads_all_again_and_changes_nothing(spark, world):
    path, table, _ = world
    land(spark, path, ("a", 1.0), ("b", 2.0))
    run(spark, world)
    before = stored(table)
    run(spark, world, checkpoint="-new")
    assert stored(table) == before and silver.batch_metrics(table).count() == 2


@pytest.mark.parametrize("dies", ["before the rows", "before the keys", "after the keys"])
def test_a_replayed_batch_is_written_once(spark, world, dies, monkeypatch):
    path, table, _ = world
    land(spark, path, ("a", 1.0), ("b", 2.0))
    write, insert = WrittenTable.write, WrittenTable.insert_absent

    def fails(self, df, write_id, *told):
        if dies == "before the keys":
            write(self, df, write_id)
        if dies == "after the keys":
            insert(self, df, write_id)
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(WrittenTable, "insert_absent" if dies == "after the keys" else "write", fails)
        with pytest.raises(Exception, match="killed"):
            run(spark, world)
    run(spark, world)
    assert stored(table) == [("a", 1.0), ("b", 2.0)]
    assert silver.batch_metrics(table).count() == 1
    assert sorted(r["transaction_id"] for r in table.keys().collect()) == ["a", "b"]


def test_rows_without_an_id_never_reach_silver(spark, world):
    path, table, _ = world
    for _ in range(2):
        land(spark, path, (None, 1.0), ("z", 1.0, "app", "2612-05-04T00:00:00"))
        run(spark, world)
    assert stored(table) == []
    assert [m["n_rejected"] for m in silver.batch_metrics(table).collect()] == [2, 2]


def test_channels_are_passed_through(spark, world):
    path, table, ckpt = world
    land(spark, path, ("a", 1.0, "kiosk", "2024-01-01T00:00:00"), ("b", 1.0))
    loose = WrittenTable(spark, table.root, TRANSACTION, table_constraints(channels=("kiosk",)))
    silver.run_silver(landing.stream_landing(spark, path), loose, ckpt, channels=("kiosk",))
    assert [i for i, _ in stored(loose)] == ["a"]


def test_a_batch_does_not_read_the_rows_of_silver(spark, world):
    path, table, _ = world
    land(spark, path, ("a", 1.0))
    run(spark, world)
    from silverlane.sources import writes

    new = spark.createDataFrame([], table.schema)
    absent = writes.absent(writes._hashed(new, table.key), table.keys(), table.key)
    scans = [line for line in absent._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation" in line]
    assert len(scans) <= 2
    read = table.keys().inputFiles()
    assert read and all("/keys/" in f for f in read)


def test_compacted_keys_say_the_same(spark, world):
    path, table, ckpt = world
    for name in "abc":
        land(spark, path, (name, 1.0))
        run(spark, world)
    compacted = table.compact_keys("keys-2")
    assert sorted(r["transaction_id"] for r in compacted.keys().collect()) == ["a", "b", "c"]
    assert compacted.keys().select(WRITE_ID).distinct().count() == 1
    land(spark, path, ("b", 5.0), ("d", 4.0))
    silver.run_silver(landing.stream_landing(spark, path), compacted, ckpt)
    assert stored(compacted) == [("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", 4.0)]


def test_a_batch_without_valid_rows(spark, world):
    path, table, _ = world
    land(spark, path, ("bad", -1.0), "not json at all")
    run(spark, world)
    assert stored(table) == []
    m = silver.batch_metrics(table).first()
    assert (m["n_raw"], m["n_valid"], m["n_inserted"]) == (2, 0, 0)


def test_an_interval_trigger_keeps_running(spark, world):
    path, table, ckpt = world
    land(spark, path, ("a", 1.0))
    query = silver.start_silver(landing.stream_landing(spark, path), table, ckpt, "1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and stored(table) == [("a", 1.0)]
    finally:
        query.stop()


def test_batch_reading(spark, where):
    missing = landing.read_landing(spark, f"{where}/nothing")
    assert missing.count() == 0
    land(spark, f"{where}/in", ("a", 1.0), "{broken")
    found = landing.read_landing(spark, f"{where}/in")
    assert found.columns == missing.columns
    assert found.schema == missing.schema or found.dtypes == missing.dtypes
    rows = {r["transaction_id"]: r for r in found.collect()}
    assert rows["a"]["layer"] == "bronze" and rows["a"]["_corrupt_record"] is None
    assert rows[None]["_corrupt_record"] == "{broken"


def test_missing_folders(spark, where):
    assert landing.inventory(spark, f"{where}/nothing").collect() == []
    assert landing.inventory_total(landing.inventory(spark, f"{where}/nothing")).first()["n_files"] == 0
    table = WrittenTable(spark, f"{where}/silver", TRANSACTION)
    silver.run_silver(landing.stream_landing(spark, f"{where}/later"), table, f"{where}/ckpt")
    assert stored(table) == []
    land(spark, f"{where}/later", ("a", 1.0))
    silver.run_silver(landing.stream_landing(spark, f"{where}/later"), table, f"{where}/ckpt")
    assert stored(table) == [("a", 1.0)]


def test_unknown_fields_are_kept(spark, where):
    lines = ['{"transaction_id": "a", "amount": 1.5, "new": {"x": [1, 2]}, "more": null}', '{"transaction_id": "b"}', "", "[1"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{where}/in")
    rows = {r["transaction_id"]: r for r in landing.read_landing(spark, f"{where}/in").collect()}
    assert json.loads(rows["a"]["_other_fields"])["new"] == '{"x":[1,2]}'
    assert rows["b"]["_other_fields"] is None and rows[None]["_corrupt_record"] == "[1"


@pytest.mark.parametrize(
    "line, other",
    [
        ('{"transaction_id": "a", "amount": 1}', None),
        ('{"transaction_id": "a", "city": null}', None),
        ('{"transaction_id": "a", "city": "x\\":y", "ts": "2024-01-01T10:00:00"}', None),
        ('{"transaction_id": "a", "transaction_id": "b"}', None),
        ('{"transaction_id": null, "new": 1}', {"new": "1"}),
        ('{"new" : 1}', {"new": "1"}),
        ("{'transaction_id': 'a', 'new'\t: 'x'}", {"new": "x"}),
        ('{"transaction_id": {"deep": 1}, "": 2}', {"": "2"}),
        ('{"Amount": 2, "amount": "no number"}', {"Amount": "2"}),
        ("no json", None),
        ("3", None),
    ],
)
def test_lines_are_parsed_again_only_for_fields_the_schema_does_not_have(spark, where, line, other):
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{where}/in")
    (row,) = landing.read_landing(spark, f"{where}/in").collect()
    assert (row["_other_fields"] and json.loads(row["_other_fields"])) == other


def test_a_stream_uses_the_saved_schema(spark, where):
    land(spark, f"{where}/in", ("a", 1.0))
    first = landing.stream_landing(spark, f"{where}/in", saved_at=f"{where}/schema")
    spark.createDataFrame([('{"fresh": 1}',)], "value string").write.mode("append").text(f"{where}/in")
    again = landing.stream_landing(spark, f"{where}/in", saved_at=f"{where}/schema")
    assert first.columns == again.columns and "fresh" not in again.columns and "amount" in again.columns


def test_other_read_failures_are_not_hidden(spark, where):
    def read(path):
        return spark.read.parquet(path).select("no_such_column")

    spark.range(1).write.parquet(f"{where}/t")
    with pytest.raises(Exception, match="no_such_column"):
        landing.read_if_present(spark, read, f"{where}/t", TRANSACTION)


def test_the_inferred_schema_is_kept(spark, where):
    land(spark, f"{where}/in", ("a", 1.0))
    first = landing.infer_schema(spark, f"{where}/in", f"{where}/schema")
    assert first["amount"].dataType.simpleString() == "double"
    spark.createDataFrame([('{"other": 1}',)], "value string").write.mode("append").text(f"{where}/in")
    assert landing.infer_schema(spark, f"{where}/in", f"{where}/schema") == first
    assert landing.infer_schema(spark, f"{where}/in") != first
    shown = {r["column"]: r["type"] for r in landing.schema_table(spark, first).collect()}
    assert shown["amount"] == "double"


def test_inventory(spark, where):
    land(spark, f"{where}/in", ("a", 1.0))
    land(spark, f"{where}/in", ("b", 1.0))
    files = landing.inventory(spark, f"{where}/in", "*.txt")
    names = [r["name"] for r in files.collect()]
    assert names == sorted(names) and len(names) == 2
    total = landing.inventory_total(files).first()
    assert total["n_files"] == 2 and total["total_kb"] > 0
    assert "content" not in files._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
