"""Inputs derived from the `events` table; `oracle.py` writes the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlane.operators.quality import clean

# Detector parameters that fit the spacing of `events`.
Z = 3.0
WINDOW_S = 86_400
MAX_TX = 5


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows with the dirt the rules are for, and a second copy of some."""
    e = events(spark, sf_dir)
    channel = (
        F.when(F.col("event_type") == "view", "app")
        .when(F.col("event_type") == "click", "qr")
        .when(F.col("event_type") == "signup", "corresponsal")
        .when(F.col("event_type") == "purchase", "api")
        .otherwise("other")
    )
    base = e.select(
        F.concat(F.lit("tx_"), F.col("event_id")).alias("transaction_id"),
        F.concat(F.lit("u_"), F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 23 == 0, -F.col("value")).otherwise(F.col("value")).alias("amount"),
        channel.alias("channel"),
        F.concat(F.lit("city_"), F.col("user_id") % 10).alias("city"),
        F.concat(F.lit("dev_"), F.col("user_id")).alias("device"),
        F.when(F.col("event_id") % 31 == 0, F.lit("not-a-ts")).otherwise(F.col("ts").cast("string")).alias("ts"),
        "event_id",
    )
    copies = F.when(F.col("event_id") % 19 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`raw` with the columns of the landed data only."""
    return raw(spark, sf_dir).drop("event_id")


def silver(spark: SparkSession, sf_dir: str, on_bad_ts: str = "reject") -> DataFrame:
    """Validated rows, still with the event_id the inputs below are derived from."""
    return clean(raw(spark, sf_dir), on_bad_ts).withColumns(
        {"layer": F.lit("silver"), "is_fraud": F.lit(False)}
    )


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in which every tenth row belongs to a user of its own."""
    return events(spark, sf_dir).select(
        F.concat(F.lit("e_"), F.col("event_id")).alias("transaction_id"),
        F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("solo_"), F.col("event_id")))
        .otherwise(F.concat(F.lit("u_"), F.col("user_id")))
        .alias("user_id"),
        F.col("event_type").alias("channel"),
        F.col("value").alias("amount"),
    )


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An access log in the shape of the audit table."""
    e = events(spark, sf_dir)
    action = (
        F.when(F.col("event_type") == "view", "getTable")
        .when(F.col("event_type") == "click", "selectFromTable")
        .when(F.col("event_type") == "signup", "createTable")
        .when(F.col("event_type") == "purchase", "alterTable")
        .otherwise("deleteTable")
    )
    table = F.when(F.col("event_id") % 3 == 0, "other.x").otherwise(
        F.concat(F.lit("main.payments.t"), F.col("event_id") % 4)
    )
    return e.select(
        F.col("ts").cast("timestamp").alias("event_time"),
        F.struct(F.concat(F.lit("user_"), F.col("user_id") % 7).alias("email")).alias("user_identity"),
        F.lit("catalog").alias("service_name"),
        action.alias("action_name"),
        F.create_map(F.lit("table_full_name"), table).alias("request_params"),
    )


def members(spark: SparkSession) -> DataFrame:
    """Who belongs to which group."""
    return spark.createDataFrame(
        [("analyst", "risk"), ("auditor", "compliance"), ("root", "admins")],
        "user_name string, grp string",
    )


def layered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated rows of which every fourth still counts as bronze."""
    return silver(spark, sf_dir).withColumn(
        "layer", F.when(F.col("event_id") % 4 == 0, "bronze").otherwise("silver")
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of which some lack an id or a user, come from the future, or use a channel of their own."""
    n = F.col("event_id")
    return raw(spark, sf_dir).select(
        F.when(n % 29 != 0, F.col("transaction_id")).alias("transaction_id"),
        F.when(n % 37 != 0, F.col("user_id")).alias("user_id"),
        "amount",
        F.when(n % 41 == 0, F.lit("kiosk")).otherwise(F.col("channel")).alias("channel"),
        "city",
        "device",
        F.when(n % 43 == 0, F.lit("2999-01-01 00:00:00")).otherwise(F.col("ts")).alias("ts"),
        "event_id",
    )
