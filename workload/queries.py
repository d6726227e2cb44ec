"""One query per operator. Each takes (spark, sf_dir) and runs over the whole tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.functions.rules import table_constraints
from silverlane.governance import audit as access
from silverlane.governance import catalog, contract, security
from silverlane.operators import compat, detect, quality, sketches
from silverlane.operators.skew import Share, split_by_share
from silverlane.plans import evaluation, profiles, ranking
from silverlane.plans.gold import gold_alerts as score
from silverlane.plans.gold import replace_gold
from silverlane.plans.incremental import ScoreStore
from silverlane.schema import CORRUPT, OTHER, TRANSACTION, VALID_CHANNELS
from silverlane.scratch import run_dir
from silverlane.sources import compaction, footers, landing, tables, writes
from silverlane.sources.evolving import EvolvingTable
from silverlane.streaming.bronze import run_bronze
from silverlane.streaming.progress import ProgressLog, backlog
from silverlane.streaming.silver import batch_metrics, run_silver, start_silver
from workload import inputs as given
from workload.inputs import MAX_TX, WINDOW_S, Z

ROW = ["transaction_id", "user_id", "amount", "channel", "city", "device", "ts"]
UTC = dt.timezone.utc
FIRST_LOAD, SECOND_LOAD = "load-0", "load-1"
LOADED_AT = {
    FIRST_LOAD: dt.datetime(2024, 2, 1, tzinfo=UTC),
    SECOND_LOAD: dt.datetime(2024, 3, 1, tzinfo=UTC),
}
BETWEEN_LOADS = dt.datetime(2024, 2, 15, tzinfo=UTC)


def _share(spark: SparkSession, sf: str) -> Share:
    """Frequent keys are looked for in bronze, before its copies are removed."""
    return Share(count_in=given.bronze(spark, sf))


def _low_share(spark: SparkSession, sf: str) -> Share:
    """Low enough that most users and all channels of the test tables count as frequent."""
    return Share(min_rows=40, max_keys=1_000, count_in=given.bronze(spark, sf))


CONTRACT = contract.Contract(
    product_id="ledger-entries",
    domain="ledger",
    owner_team="bookkeeping",
    owner_email="bookkeeping@example.org",
    sla_freshness="one hour",
    sla_availability="99 of 100 reads",
    quality_tests="silver_refusals",
    classification="internal",
    pii_columns="device",
    regulatory="none",
    retention_days="400",
    version="3",
    status="in use",
)
DOMAINS = {
    "ledger": "Transactions as landed and as cleaned",
    "watch": "Scored transactions",
    "people": "Group membership and what each group may read",
}
# What a run needs: also the domain that stores no table here.
REQUIRED = DOMAINS | {"outlets": "Channels that transactions come in through"}
COLUMN_NOTES = {
    "transaction_id": "text; from the landed file; never null; one row each",
    "user_id": "text; from the landed file; never null",
    "amount": "currency units, above zero; from the landed file; never null",
    "channel": "one of the valid channels; from the landed file; never null",
    "city": "text; from the landed file; null if it was not sent",
    "device": "text; from the landed file; null if it was not sent; masked for most readers",
    "ts": "time in the zone of the session, parsed from text; never null",
    "is_fraud": "true or false; set by the detectors, false until then; never null",
    "processed_at": "time in the zone of the session; set when the row was cleaned; never null",
    "layer": "bronze, silver or gold; set by the pipeline; never null; partitions the files",
}
TABLE_NOTE = "Transactions that the quality rules accept, one row each"


def _second_load() -> Column:
    """Rows from this time on arrive with the second load."""
    return F.lit("2024-01-21 00:00:00").cast("timestamp")


def _shown(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Chosen columns, times as wall clock so that no session zone shifts them."""
    df = df if columns is None else df.select(*columns)
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


def _written(spark: SparkSession, name: str, like: DataFrame) -> writes.WrittenTable:
    """An empty table with the columns of `like`, the layer last."""
    columns = [c for c in like.columns if c != "layer"]
    schema = like.select(*columns, "layer").schema
    return writes.WrittenTable(spark, run_dir(spark, name), schema)


# -- quality -----------------------------------------------------------------------------


def quality_valid(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(quality.clean(given.bronze(spark, sf)), ROW)


def quality_valid_keep_null_ts(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(quality.clean(given.bronze(spark, sf), on_bad_ts="keep"), ROW)


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(given.bronze(spark, sf))


def quality_reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reject_reasons(given.bronze(spark, sf))


def bronze_vs_silver(spark: SparkSession, sf: str) -> DataFrame:
    return quality.compare_layers(given.bronze(spark, sf), given.silver(spark, sf))


def silver_channel_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.channel_report(given.silver(spark, sf))


def constraint_violations(spark: SparkSession, sf: str) -> DataFrame:
    rows = given.bronze(spark, sf).withColumn("ts", F.col("ts").try_cast("timestamp"))
    latest = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return quality.constraint_violations(rows, table_constraints(as_of=latest))


# -- detectors ---------------------------------------------------------------------------


def _z_shown(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id",
        F.round("user_avg", 8).alias("user_avg"),
        F.round("user_std", 6).alias("user_std"),
        "zscore_alert",
    )


def zscore_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return _z_shown(detect.zscore_alerts(given.silver(spark, sf), Z, share=_share(spark, sf)))


def zscore_alerts_split(spark: SparkSession, sf: str) -> DataFrame:
    return _z_shown(detect.zscore_alerts(given.silver(spark, sf), Z, share=_low_share(spark, sf)))


FREQUENCY = ["transaction_id", "window_tx", "frequency_alert"]


def frequency_alerts(spark: SparkSession, sf: str) -> DataFrame:
    silver, share = given.silver(spark, sf), _share(spark, sf)
    return detect.frequency_alerts(silver, WINDOW_S, MAX_TX, share=share).select(FREQUENCY)


def frequency_alerts_split(spark: SparkSession, sf: str) -> DataFrame:
    silver = given.silver(spark, sf)
    share = _low_share(spark, sf)
    return detect.frequency_alerts(silver, WINDOW_S, MAX_TX, share=share).select(FREQUENCY)


def frequency_alerts_untimed(spark: SparkSession, sf: str) -> DataFrame:
    silver = given.silver(spark, sf, on_bad_ts="keep")
    share = _low_share(spark, sf)
    return detect.frequency_alerts(silver, WINDOW_S, MAX_TX, share=share).select(FREQUENCY)


def zscore_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return detect.zscore_fallback(given.sparse(spark, sf), Z).select(
        "transaction_id", "zscore_alert"
    )


def zscore_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """The detector on other columns: orders far above the customer's mean."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    judged = detect.zscore_alerts(orders, 2.0, "o_custkey", "o_totalprice", keep_stats=False)
    return judged.select("o_orderkey", "zscore_alert")


def fallback_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Orders judged by their priority where the customer has no usable deviation."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    judged = detect.zscore_fallback(
        orders, 1.5, user="o_custkey", amount="o_totalprice", channel="o_orderpriority"
    )
    return judged.select("o_orderkey", "zscore_alert")


def _by_supplier(spark: SparkSession, sf: str, share: Share) -> DataFrame:
    """Lines shipped per supplier within a week; every line of a day shares one second."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    judged = detect.frequency_alerts(lines, 7 * 86_400, 3, "l_suppkey", "l_shipdate", share=share)
    return judged.select("l_orderkey", "l_linenumber", "l_suppkey", "window_tx", "frequency_alert")


def frequency_by_supplier(spark: SparkSession, sf: str) -> DataFrame:
    return _by_supplier(spark, sf, Share())


def frequency_by_supplier_split(spark: SparkSession, sf: str) -> DataFrame:
    return _by_supplier(spark, sf, Share(min_rows=300, max_keys=10_000))


def zscore_v1_v2_compare(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.compare_zscore_versions(given.sparse(spark, sf), Z)


def deterministic_sample(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.sample_by_hash(given.sparse(spark, sf), 5_000)


# -- Gold --------------------------------------------------------------------------------

GOLD = [
    *ROW,
    "layer",
    "is_fraud",
    "zscore_alert",
    "window_tx",
    "frequency_alert",
    "alert",
    "score",
    "risk_level",
]


def _gold(
    spark: SparkSession,
    sf: str,
    z: float = Z,
    max_tx: int = MAX_TX,
    share: Share | None = None,
) -> DataFrame:
    silver = given.silver(spark, sf).drop("event_id")
    return score(silver, z, WINDOW_S, max_tx, share or _share(spark, sf))


def gold_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_gold(spark, sf), GOLD)


def gold_alerts_split(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_gold(spark, sf, share=_low_share(spark, sf)), GOLD)


def gold_alerts_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Gold replaced by a run with other thresholds."""
    silver, share, path = given.silver(spark, sf).drop("event_id"), _share(spark, sf), run_dir(spark, "gold")
    replace_gold(path, silver, share=share)
    thresholds = {"z_threshold": "2.5", "window_s": str(WINDOW_S), "max_tx": "4"}
    replace_gold(path, silver, thresholds, share)
    return _shown(spark.read.parquet(path), GOLD)


def gold_from_landed_files(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way: JSON files, stream, stored Silver, stored Gold."""
    silver = _streamed(spark, sf).read().where(F.col("layer") == "silver")
    path = run_dir(spark, "gold")
    replace_gold(path, silver, {"window_s": str(WINDOW_S)})
    return _shown(spark.read.parquet(path), GOLD)


def gold_table(spark: SparkSession, sf: str) -> DataFrame:
    """Gold overwritten as a table partitioned by layer, and read back."""
    name, path = _table(spark, "watch", "alerts")
    tables.overwrite_table(_gold(spark, sf), name, path)
    return _shown(tables.layer_scan(spark, name, "gold"), GOLD)


def _labels(spark: SparkSession, sf: str, share: Share) -> DataFrame:
    """Three detectors in a chain over one split."""
    split = split_by_share(given.silver(spark, sf), ["user_id"], share)
    judged = (
        split.transform(detect.zscore_alerts, threshold=Z)
        .transform(detect.frequency_alerts, window_s=WINDOW_S, max_tx=MAX_TX, share=share)
        .transform(detect.label_confirmed)
    )
    return judged.rows().select("transaction_id", "user_id", "is_fraud")


def fraud_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf, _share(spark, sf))


def fraud_labels_split(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf, _low_share(spark, sf))


def confirmed_users(spark: SparkSession, sf: str) -> DataFrame:
    both = F.col("zscore_alert") & F.col("frequency_alert")
    return evaluation.users_with(_gold(spark, sf), both)


def fraud_share(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.fraud_share(_gold(spark, sf))


def detector_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.detector_metrics(_gold(spark, sf))


def detector_metrics_external(spark: SparkSession, sf: str) -> DataFrame:
    """Judged by labels that do not come from the detectors: here, purchases over 100."""
    labels = given.raw(spark, sf).select(
        "transaction_id", ((F.col("channel") == "api") & (F.col("amount") > 100)).alias("is_fraud")
    )
    return evaluation.detector_metrics(detect.label_from(_gold(spark, sf), labels))


def alerts_by_level_channel(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.alerts_by_level_channel(_gold(spark, sf))


def top_alerted_users(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.top_alerted_users(_gold(spark, sf), 10)


def top_users_by_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """The same from lists kept by month, of which only the rows that matter are added up."""
    path = run_dir(spark, "alert-lists")
    months = _gold(spark, sf).withColumn("month", F.date_format("ts", "yyyy-MM"))
    ranking.keep(ranking.alert_list(months, "month"), path, "month")
    return ranking.top_users(spark, path, 10, "month")


# -- profiles ----------------------------------------------------------------------------


def profile_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.profile_by_channel(given.silver(spark, sf), share=_share(spark, sf))


def profile_by_channel_split(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.profile_by_channel(given.silver(spark, sf), share=_low_share(spark, sf))


def profile_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return profiles.profile_by_channel(
        orders, "o_orderpriority", "o_totalprice", Share(min_rows=0, max_keys=1_000)
    )


def profile_by_city(spark: SparkSession, sf: str) -> DataFrame:
    city = profiles.profile_by_city(given.silver(spark, sf))
    return city.withColumn("volume_millions", F.round("volume_millions", 8))


def activity_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.activity_by_hour(given.silver(spark, sf))


# -- Silver writes -----------------------------------------------------------------------


def silver_insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """The first weeks, then everything with other amounts, twice: the first writer wins."""
    path = run_dir(spark, "cleaned")
    given.silver(spark, sf).select(*ROW, "layer").write.parquet(path)  # cleaned once for all three loads
    silver = spark.read.parquet(path)
    early = silver.where(F.col("ts") < _second_load())
    late = silver.withColumn("amount", F.col("amount") + 1000)
    table = _written(spark, "silver", early)
    for load, rows in (("load-1", early), ("load-2", late), ("load-2-again", late)):
        table.insert_absent(rows, load)
    return _shown(table.read(), ROW)


def silver_stream_constraints(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without id or user, from the future or of a foreign channel never reach Silver, in any batch."""
    rows, source, root = given.dirty(spark, sf), run_dir(spark, "landing"), run_dir(spark, "stream")
    channels = (*VALID_CHANNELS, "kiosk")
    checks = table_constraints(channels=channels)
    table = writes.WrittenTable(spark, f"{root}/silver", TRANSACTION, checks)
    for part in (rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")):
        landing.land(part.drop("event_id"), source)
        run_silver(landing.stream_landing(spark, source), table, f"{root}/checkpoint", channels)
    return _shown(table.read(), [*ROW, "layer"])


def quality_reject_reasons_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Every reason for refusing a row."""
    latest = F.lit("2024-12-31 00:00:00").cast("timestamp")
    return quality.reject_reasons(given.dirty(spark, sf).drop("event_id"), as_of=latest)


def _landed(spark: SparkSession, sf: str) -> str:
    path = run_dir(spark, "landing")
    landing.land(given.bronze(spark, sf), path)
    return path


def bronze_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Landed JSON read in batch, kept as a table with its lineage, and read back."""
    name, path = _table(spark, "ledger", "bronze_snapshot")
    tables.overwrite_table(landing.read_landing(spark, _landed(spark, sf)), name, path)
    return _shown(
        tables.layer_scan(spark, name, "bronze")
        .withColumn("ts", F.col("ts").try_cast("timestamp"))
        .withColumn("has_lineage", F.col("source_file").isNotNull() & F.col("ingested_at").isNotNull()),
        [*ROW, "layer", "is_fraud", "has_lineage"],
    )


def _streamed(spark: SparkSession, sf: str) -> writes.WrittenTable:
    source, root = _landed(spark, sf), run_dir(spark, "stream")
    table = writes.WrittenTable(spark, f"{root}/silver", TRANSACTION, table_constraints())
    for _ in range(2):  # the second run finds nothing new
        stream = landing.stream_landing(spark, source, saved_at=f"{root}/schema")
        run_silver(stream, table, f"{root}/checkpoint")
    return table


def bronze_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_streamed(spark, sf).read(), [*ROW, "layer", "is_fraud"])


def bronze_unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Landed rows with fields the schema does not have, which are kept as text."""
    path = run_dir(spark, "landing")
    rows = given.raw(spark, sf).withColumn("coupon", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("c"), "event_id")))
    landing.land(rows.withColumnRenamed("event_id", "event"), path)
    found = landing.read_landing(spark, path)
    coupon, event = (F.get_json_object(OTHER, f"$.{name}") for name in ("coupon", "event"))
    return found.select("transaction_id", "amount", coupon.alias("coupon"), event.cast("long").alias("event"))


def bronze_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Three landings, each with a new or wider field, and the types they end up with."""
    e, path, root = given.events(spark, sf), run_dir(spark, "landing"), run_dir(spark, "bronze")
    n, city = F.col("event_id"), F.concat(F.lit("city_"), F.col("user_id") % 10)
    zoned = F.struct(city.alias("city"), (F.col("user_id") % 3).alias("zone"))
    landings = (
        (n.alias("id"), F.floor("value").alias("amount"), n.alias("code"), F.struct(city.alias("city")).alias("place")),
        (n.alias("id"), F.col("value").alias("amount"), n.alias("code"), F.concat(F.lit("c"), n).alias("coupon")),
        (n.alias("id"), F.floor("value").alias("amount"), F.concat(F.lit("k"), n).alias("code"), zoned.alias("place")),
    )
    table = EvolvingTable(spark, f"{root}/rows")
    for k, columns in enumerate(landings):
        landing.land(e.where(n % 3 == k).select(*columns), path)
        run_bronze(spark, path, table, f"{root}/checkpoint")
    rows = table.read()
    types = F.concat_ws(", ", *[F.lit(f"{f.name} {f.dataType.simpleString()}") for f in sorted(rows.schema.fields[:5], key=lambda f: f.name)])
    aside = F.col(OTHER).isNotNull() | F.col(CORRUPT).isNotNull()
    return rows.select(
        "id", "amount", "code", "coupon", "place.city", "place.zone", "schema_version", types.alias("types"), aside.alias("kept_aside")
    )


def gold_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads in which every user's rows are mixed, each scoring only the users it touches."""
    path, root = run_dir(spark, "cleaned"), run_dir(spark, "scores")
    given.silver(spark, sf).write.parquet(path)  # cleaned once for all loads
    silver = spark.read.parquet(path)
    store = ScoreStore(spark, f"{root}/store", silver.drop("event_id").schema, buckets=4)
    for k in (2, 0, 1):
        store.add(silver.where(F.col("event_id") % 3 == k), f"load-{k}")
        store.refresh(f"{root}/gold", f"load-{k}", z_threshold=Z, window_s=WINDOW_S, max_tx=MAX_TX)
    return _shown(spark.read.parquet(f"{root}/gold"), GOLD)


def stream_batch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Totals over the micro-batches; how many there were depends on the files."""
    sums = [F.sum(c).alias(c) for c in ("n_raw", "n_valid", "n_rejected", "n_inserted")]
    return batch_metrics(_streamed(spark, sf)).agg(*sums)


def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """What a listener kept of every batch, held against what the batches counted themselves."""
    source, root = _landed(spark, sf), run_dir(spark, "stream")
    table = writes.WrittenTable(spark, f"{root}/silver", TRANSACTION, table_constraints())
    log = ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        stream = landing.stream_landing(spark, source, saved_at=f"{root}/schema", max_files_per_trigger=5)
        query = start_silver(stream, table, f"{root}/checkpoint")
        query.awaitTermination()
        log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    kept = log.read().where("n_input > 0")
    seen = kept.agg(
        F.sum("n_input").alias("n_input"),
        (F.count(F.lit(1)) == F.countDistinct("batch_id")).alias("once_a_batch"),
        F.every((F.col("rows_per_s") > 0) & (F.col("duration_ms") > 0)).alias("timed"),
        F.count(F.lit(1)).alias("n_batches"),
    )
    counted = batch_metrics(table).agg(F.sum("n_raw").alias("n_raw"), F.count(F.lit(1)).alias("n_counted"))
    taken = backlog(spark, source, f"{root}/checkpoint")
    left = taken.agg(F.min_by("files_left", F.coalesce("batch_id", F.lit(-1))).alias("first"), F.max_by("files_left", "batch_id").alias("at_end"))
    same = (F.col("n_batches") == F.col("n_counted")).alias("all_batches")
    shrinks = (F.col("first") > F.col("at_end")) | (F.col("n_batches") == 1)
    shown = seen.join(counted, F.lit(True)).join(left, F.lit(True))
    return shown.select("n_input", "n_raw", "once_a_batch", "timed", same, shrinks.alias("backlog_shrinks"), F.col("at_end").alias("backlog_at_end"))


def stream_empty_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of which no row is valid: nothing is written, but it is counted."""
    source, root = run_dir(spark, "landing"), run_dir(spark, "stream")
    landing.land(given.bronze(spark, sf).where("amount <= 0"), source)
    table = writes.WrittenTable(spark, f"{root}/silver", TRANSACTION, table_constraints())
    run_silver(landing.stream_landing(spark, source), table, f"{root}/checkpoint")
    return batch_metrics(table).select("n_raw", "n_valid", "n_rejected", "n_inserted")


def stream_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """All landed files taken in again from the beginning, by a query that knows nothing of the first: no row comes twice."""
    source, root = _landed(spark, sf), run_dir(spark, "stream")
    table = writes.WrittenTable(spark, f"{root}/silver", TRANSACTION, table_constraints())
    for checkpoint in ("first", "second"):
        run_silver(landing.stream_landing(spark, source), table, f"{root}/{checkpoint}")
    return _shown(table.read(), [*ROW, "layer", "is_fraud"])


def refused_writes(spark: SparkSession, sf: str) -> DataFrame:
    """Writes with a row that violates a constraint are refused whole: the rows stored after each attempt."""
    rows = given.silver(spark, sf).withColumn("processed_at", F.current_timestamp())
    rows = rows.withColumns({"source_file": F.lit(None).cast("string"), "ingested_at": F.current_timestamp()})
    odd, even = rows.where("event_id % 2 = 1"), rows.where("event_id % 2 = 0")
    table = writes.WrittenTable(spark, run_dir(spark, "refused"), TRANSACTION, table_constraints())
    one = F.col("event_id") % 101 == 1
    attempts = {
        "even rows": even,
        "negative amounts": odd.withColumn("amount", F.when(one, -F.col("amount")).otherwise(F.col("amount"))),
        "foreign channel": odd.withColumn("channel", F.when(one, "pigeon").otherwise(F.col("channel"))),
        "odd rows": odd,
    }
    told = []
    for name, batch in attempts.items():
        try:
            table.write(batch, name)
            refused = False
        except SparkRuntimeException:
            refused = True
        told.append((name, refused, table.read().count()))
    return spark.createDataFrame(told, "attempt string, refused boolean, n_rows long")


def landing_partly_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by day folder, of which one has not landed yet."""
    path = run_dir(spark, "landing")
    rows = given.raw(spark, sf)
    for day in (0, 2):
        landing.land(rows.where(F.col("event_id") % 3 == day).drop("event_id"), f"{path}/day-{day}")
    read = [landing.read_landing(spark, f"{path}/day-{day}").withColumn("day", F.lit(day)) for day in range(3)]
    found = read[0].unionByName(read[1]).unionByName(read[2])
    days = spark.range(3).select(F.col("id").cast("int").alias("day"))
    return days.join(found, "day", "left").groupBy("day").agg(F.count("transaction_id").alias("n_rows"))


def silver_scan(spark: SparkSession, sf: str) -> DataFrame:
    name, path = _table(spark, "ledger", "transactions")
    tables.overwrite_table(given.layered(spark, sf).drop("event_id"), name, path)
    return _shown(tables.layer_scan(spark, name, "silver"), ROW)


def table_append(spark: SparkSession, sf: str) -> DataFrame:
    """A table overwritten with one layer, to which the other is appended."""
    name, path = _table(spark, "ledger", "transactions")
    rows = given.layered(spark, sf).drop("event_id")
    tables.overwrite_table(rows.where("layer = 'bronze'"), name, path)
    tables.append_table(rows.where("layer = 'silver'"), name)
    return _shown(spark.table(name), [*ROW, "layer"])


# -- writes ------------------------------------------------------------------------------


def _loads(spark: SparkSession, sf: str) -> DataFrame:
    """A table of two writes: the first weeks, and the rest."""
    rows = given.events(spark, sf).select(
        F.concat(F.lit("tx_"), F.col("event_id")).alias("transaction_id"),
        F.concat(F.lit("u_"), F.col("user_id")).alias("user_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("channel"),
        F.concat(F.lit("city_"), F.col("user_id") % 10).alias("city"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("ts").cast("timestamp").alias("processed_at"),
        F.lit("silver").alias("layer"),
    )
    table = _written(spark, "loads", rows)
    table.write(rows.where(F.col("ts") < _second_load()), FIRST_LOAD, LOADED_AT[FIRST_LOAD])
    table.write(rows.where(F.col("ts") >= _second_load()), SECOND_LOAD, LOADED_AT[SECOND_LOAD], "append")
    return table.read()


def snapshot_compare(spark: SparkSession, sf: str) -> DataFrame:
    moments = {"version 0": [FIRST_LOAD], "version 1": [FIRST_LOAD, SECOND_LOAD], "current": None}
    return writes.compare_writes(_loads(spark, sf), moments)


def snapshot_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(writes.audit_sample(_loads(spark, sf), [FIRST_LOAD], n=5))


def snapshot_asof_time(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of all writes up to a time."""
    rows = writes.as_of(_loads(spark, sf), BETWEEN_LOADS)
    return _shown(rows, ["transaction_id", "user_id", "amount", "channel", "ts"])


def _by_write(spark: SparkSession, sf: str) -> DataFrame:
    first = F.col("ts") < _second_load()
    return given.silver(spark, sf).withColumn("load", F.when(first, FIRST_LOAD).otherwise(SECOND_LOAD))


def percentiles_by_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Median and 95th percentile by channel from sketches kept by write, held against the exact ranks."""
    rows, path, wanted = _by_write(spark, sf), run_dir(spark, "sketches"), {"median": 0.5, "p95": 0.95}
    sketches.amount_sketches(rows, "load", "channel").write.parquet(path)
    found = sketches.quantiles_of(spark.read.parquet(path), "channel", wanted)
    errors = sketches.rank_errors(rows, found, "channel", wanted)
    within = [(F.col(name) <= sketches.RANK_ERROR).alias(f"{name}_within") for name in wanted]
    return errors.select("channel", "total", *within)


def users_by_write(spark: SparkSession, sf: str) -> DataFrame:
    """Users of either, both or only one of two loads, from sketches kept by write."""
    path = run_dir(spark, "sketches")
    rows = _by_write(spark, sf).where((F.col("load") == FIRST_LOAD) | (F.col("event_id") % 5 == 0))
    sketches.distinct_sketches(rows, "user_id", "load").write.parquet(path)
    return sketches.compare_sets(spark.read.parquet(path), "load", FIRST_LOAD, SECOND_LOAD)


def layer_file_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and bounds of each layer from the footers of its files."""
    path = run_dir(spark, "layers")
    given.layered(spark, sf).drop("event_id").write.partitionBy("layer").parquet(path)
    stats = footers.layer_file_stats(spark, path, ["amount"])
    filled = (F.col("n_files") > 0) & (F.col("total_bytes") > 0) & F.col("last_modified").isNotNull()
    return stats.select("layer", "n_rows", "min_amount", "max_amount", filled.alias("has_files"))


def compaction_plan(spark: SparkSession, sf: str) -> DataFrame:
    """A table of many small files rewritten to fewer larger ones: what must hold of the plan, and the rows afterwards."""
    path, folder = run_dir(spark, "small-files"), run_dir(spark, "compacted")
    rows = given.layered(spark, sf).drop("event_id").withColumn("slice", F.pmod(F.xxhash64("transaction_id"), F.lit(24)))
    rows.repartitionById(24, F.col("slice").cast("int")).drop("slice").write.partitionBy("layer").parquet(path)
    target = 5 * compaction.stored_files(spark, path).agg(F.max("size").alias("largest")).first().largest
    plan = compaction.compact(spark, path, folder, target, part_files=16)
    bins = plan.groupBy("layer", "bin").agg(F.sum("size").alias("held"), F.max("size").alias("largest"))
    packed = bins.groupBy("layer").agg(
        F.every(F.col("held") <= target).alias("none_over"),
        # First fit fills all bins of a part but the last by more than the target less one file; parts are some 16 files.
        (F.count(F.lit(1)) <= F.sum("held") / (target - F.max("largest")) + 3).alias("well_filled"),
        F.count(F.lit(1)).alias("n_bins"),
    )
    files = compaction.stored_files(spark, f"{folder}/rows").groupBy("layer").agg(F.count(F.lit(1)).alias("n_files"))
    written = spark.read.parquet(f"{folder}/rows").groupBy("layer").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("transaction_id").alias("n_ids"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )
    a_file_each = (F.col("n_files") == F.col("n_bins")).alias("a_file_each")
    found = packed.join(files, "layer").join(written, "layer")
    return found.select("layer", "none_over", "well_filled", a_file_each, "n_rows", "n_ids", "min_amount", "max_amount")


def schema_compat(spark: SparkSession, sf: str) -> DataFrame:
    """The events, with nested columns made of them, held against a schema in which columns are cast, gone or new."""
    e = given.events(spark, sf).withColumns(
        {
            "place": F.struct((F.col("user_id") % 10).alias("city"), (F.col("value") / 10).alias("area")),
            "readings": F.array(F.struct("value"), F.struct(F.floor("value").cast("double").alias("value"))),
            "tags": F.create_map("event_type", F.col("value")),
        }
    )
    wanted = T._parse_datatype_string(
        "event_id decimal(20,0), ts date, user_id int, value bigint, props string, source string, "
        "place struct<city: double, zone: int>, readings array<struct<value: bigint>>, tags map<string, float>"
    )
    return compat.compatibility(e, wanted)


def write_history(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(writes.history(_loads(spark, sf)))


# -- governance --------------------------------------------------------------------------


def _domains(spark: SparkSession, domains: dict[str, str] = DOMAINS) -> dict[str, str]:
    """The domain schemas, made for one run: name -> name in the catalog."""
    suffix = uuid.uuid4().hex[:12]
    names = {domain: f"{domain}_{suffix}" for domain in domains}
    comments = {names[d]: text for d, text in domains.items()}
    catalog.create_domains(spark, comments, run_dir(spark, "schemas"))
    return names


def _table(spark: SparkSession, domain: str, table: str) -> tuple[str, str]:
    return f"{_domains(spark)[domain]}.{table}", f"{run_dir(spark, 'tables')}/{table}"


def _product(
    spark: SparkSession, sf: str, domains: dict[str, str] = DOMAINS
) -> tuple[dict[str, str], str]:
    """The transactions product: typed table, filled with Silver, contract and notes."""
    names = _domains(spark, domains)
    table = f"{names['ledger']}.transactions"
    rows = given.layered(spark, sf).select(*ROW, "is_fraud", "processed_at", "layer")
    catalog.create_table(spark, table, rows.schema, column_comments=COLUMN_NOTES)
    quality.enforce(rows).write.mode("append").insertInto(table)
    contract.register_contract(spark, table, CONTRACT, TABLE_NOTE, COLUMN_NOTES)
    return names, table


def contract_table(spark: SparkSession, sf: str) -> DataFrame:
    """The contract as the catalog has it, and how many stored rows it covers."""
    _, table = _product(spark, sf)
    covered = spark.table(table).agg(F.count(F.lit(1))).scalar()
    return contract.read_contract(spark, table).withColumn("covered_rows", covered)


def table_comment(spark: SparkSession, sf: str) -> DataFrame:
    """What the catalog says of the product, and the rows it is said of."""
    _, table = _product(spark, sf)
    said = F.lit(catalog.describe(spark, table).get("comment"))
    return spark.table(table).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("comment", said)


def schemas_after_reset(spark: SparkSession, sf: str) -> DataFrame:
    """The schemas of a run with their comments, and which are left when all but one are reset."""
    names, _ = _product(spark, sf)
    made = catalog.schemas_table(spark).where(F.col("schema").isin(*names.values()))
    listed = {r["schema"]: r["description"] for r in made.collect()}
    catalog.reset(spark, [name for domain, name in names.items() if domain != "people"])
    left = {r["schema"] for r in catalog.schemas_table(spark).collect()}
    told = [(domain, listed.get(name), name in left) for domain, name in names.items()]
    return spark.createDataFrame(told, "schema string, description string, left_over boolean")


def column_documentation(spark: SparkSession, sf: str) -> DataFrame:
    """The note of each column, and how many distinct values its rows hold (0 for the time of the run)."""
    _, table = _product(spark, sf)
    shown = spark.table(table).drop("processed_at")
    counted = shown.agg(*[F.count_distinct(c).alias(c) for c in shown.columns])
    values = counted.unpivot([], shown.columns, "column", "n_values")
    noted = contract.column_documentation(spark, table).join(values, "column", "left")
    return noted.withColumn("n_values", F.coalesce("n_values", F.lit(0)))


def environment_check(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the schemas and the table a run needs are there, and the rows it would read."""
    names, table = _product(spark, sf, REQUIRED)
    n_rows = tables.layer_scan(spark, table, "silver").agg(F.count(F.lit(1))).scalar()
    checked = catalog.check_environment(spark, list(names.values()), [table, f"{table}_missing"])
    return checked.select(
        "kind",
        F.regexp_replace("name", "_[0-9a-f]{12}", "").alias("name"),
        "present",
        F.when(F.col("name") == table, n_rows).otherwise(F.lit(0)).alias("silver_rows"),
    )


def table_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each layer has files with bytes in them, and the rows they hold."""
    name, path = _table(spark, "ledger", "transactions")
    tables.overwrite_table(given.layered(spark, sf).drop("event_id"), name, path)
    rows = spark.table(name).groupBy("layer").agg(F.count(F.lit(1)).alias("n_rows"))
    detail = tables.physical_detail(spark, path)
    filled = (F.col("n_files") > 0) & (F.col("total_bytes") > 0)
    return detail.join(rows, "layer").select("layer", filled.alias("has_files"), "n_rows")


def landing_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the listed files have names, sizes and times, and the rows they hold."""
    path = _landed(spark, sf)
    listed = landing.inventory(spark, path).agg(
        (F.count(F.lit(1)) > 0).alias("has_files"),
        F.every((F.col("size_kb") >= 0) & F.col("name").endswith(".json") & F.col("modified_at").isNotNull()).alias("complete"),
    )
    n_rows = landing.read_landing(spark, path).agg(F.count(F.lit(1))).scalar()
    return listed.withColumn("n_rows", n_rows)


def inventory_total(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the totals are those of the listed files, and the rows they hold."""
    path = _landed(spark, sf)
    files = landing.inventory(spark, path)
    total = landing.inventory_total(files)
    sizes = files.agg(F.sum("size_kb")).scalar()
    n_rows = landing.read_landing(spark, path).agg(F.count(F.lit(1))).scalar()
    right = (F.col("n_files") > 0) & (F.abs(F.col("total_kb") - sizes) < 1e-6)
    return total.select(right.alias("adds_up"), n_rows.alias("n_rows"))


def schema_report(spark: SparkSession, sf: str) -> DataFrame:
    """The types Spark finds in all landed files, as rows."""
    return landing.schema_table(spark, landing.infer_schema(spark, _landed(spark, sf)))


SECURED = ["transaction_id", "user_id", "amount", "channel", "city", "device", "ts", "layer"]


def _secured(spark: SparkSession, sf: str, user: str) -> DataFrame:
    return security.secured(given.layered(spark, sf), given.members(spark), user=user)


def secured_view_analyst(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_secured(spark, sf, "analyst"), SECURED)


def secured_view_compliance(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_secured(spark, sf, "auditor"), SECURED)


def secured_view_check(spark: SparkSession, sf: str) -> DataFrame:
    """What three users see of one stored product."""
    name, path = _table(spark, "ledger", "transactions")
    tables.overwrite_table(given.layered(spark, sf).drop("event_id"), name, path)
    stored, members = spark.table(name), given.members(spark)
    seen = [
        security.check_masking(security.secured(stored, members, user=user), user)
        for user in ("analyst", "auditor", "root")
    ]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


def secured_view_current_user(spark: SparkSession, sf: str) -> DataFrame:
    """A permanent view, read by a user who is in a group without privilege."""
    names, table = _product(spark, sf)
    members = f"{names['people']}.members"
    me = spark.range(1).select(F.current_user().alias("user_name"), F.lit("risk").alias("grp"))
    me.write.saveAsTable(members)
    view = f"{names['people']}.v_transactions"
    security.create_secured_view(spark, view, table, members)
    return _shown(spark.table(view), SECURED)


def access_audit(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-01-30 00:00:00").cast("timestamp")
    return _shown(access.access_audit(given.audit(spark, sf), "catalog", "main", as_of=now))


ALL = (
    quality_valid,
    quality_valid_keep_null_ts,
    quality_report,
    quality_reject_reasons,
    bronze_vs_silver,
    silver_channel_report,
    constraint_violations,
    zscore_alerts,
    zscore_alerts_split,
    frequency_alerts,
    frequency_alerts_split,
    frequency_alerts_untimed,
    zscore_fallback,
    zscore_by_customer,
    fallback_by_customer,
    frequency_by_supplier,
    frequency_by_supplier_split,
    zscore_v1_v2_compare,
    deterministic_sample,
    gold_alerts,
    gold_alerts_split,
    gold_alerts_rerun,
    gold_from_landed_files,
    gold_table,
    fraud_labels,
    fraud_labels_split,
    confirmed_users,
    fraud_share,
    detector_metrics,
    detector_metrics_external,
    alerts_by_level_channel,
    top_alerted_users,
    top_users_by_threshold,
    profile_by_channel,
    profile_by_channel_split,
    profile_by_priority,
    profile_by_city,
    activity_by_hour,
    silver_insert_if_absent,
    silver_stream_constraints,
    quality_reject_reasons_dirty,
    bronze_snapshot,
    bronze_stream_ingest,
    bronze_unknown_fields,
    bronze_schema_evolution,
    gold_incremental,
    stream_batch_metrics,
    stream_progress,
    stream_empty_batch,
    stream_replayed,
    refused_writes,
    landing_partly_missing,
    percentiles_by_sketch,
    users_by_write,
    layer_file_stats,
    compaction_plan,
    schema_compat,
    table_comment,
    schemas_after_reset,
    silver_scan,
    table_append,
    snapshot_compare,
    snapshot_sample,
    snapshot_asof_time,
    write_history,
    contract_table,
    column_documentation,
    environment_check,
    table_detail,
    landing_inventory,
    inventory_total,
    schema_report,
    secured_view_analyst,
    secured_view_compliance,
    secured_view_check,
    secured_view_current_user,
    access_audit,
)
