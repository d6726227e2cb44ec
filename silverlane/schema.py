"""Schemas and fixed values shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# The channels that count as valid unless a caller names others.
VALID_CHANNELS = ("app", "qr", "corresponsal", "api")
LAYERS = ("bronze", "silver", "gold")
RISK_LEVELS = ("NORMAL", "MEDIUM", "CRITICAL")  # rising severity

# What one landed JSON object holds. Everything is kept as it came, so ts is text.
RAW = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("channel", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("ts", T.StringType()),
    ]
)
CORRUPT = "_corrupt_record"
OTHER = "_other_fields"  # JSON of the fields that the schema does not have

# The Silver row. `layer` is last because it is a partition column of the files.
TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("amount", T.DoubleType()),
        T.StructField("channel", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("layer", T.StringType()),
    ]
)

# Silver plus what the detectors add.
ALERT = T.StructType(
    TRANSACTION.fields[:-1]
    + [
        T.StructField("user_avg", T.DoubleType()),
        T.StructField("user_std", T.DoubleType()),
        T.StructField("zscore_alert", T.BooleanType()),
        T.StructField("window_tx", T.LongType()),
        T.StructField("frequency_alert", T.BooleanType()),
        T.StructField("alert", T.BooleanType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("risk_level", T.StringType()),
        T.StructField("layer", T.StringType()),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("user_identity", T.StructType([T.StructField("email", T.StringType())])),
        T.StructField("service_name", T.StringType()),
        T.StructField("action_name", T.StringType()),
        T.StructField("request_params", T.MapType(T.StringType(), T.StringType())),
    ]
)
