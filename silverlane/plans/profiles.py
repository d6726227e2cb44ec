"""Profiles of a table: by channel, by city, by hour, and of a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.functions.risk import percent
from silverlane.operators.quantile import exact_percentiles
from silverlane.operators.skew import Share, lookup


def _with_share(counted: DataFrame) -> DataFrame:
    """Add each group's share of all rows: the groups are summed up, the input is not read again.

    A window without keys over the groups would be one task.
    """
    everything = counted.agg(F.sum("total")).scalar()
    return counted.withColumn("pct", F.round(percent(F.col("total"), everything), 1))


def profile_by_channel(
    df: DataFrame, channel: str = "channel", amount: str = "amount", share: Share = Share()
) -> DataFrame:
    """Count, share and amount statistics per channel, largest first; percentiles are exact."""
    counted = df.groupBy(channel).agg(
        F.count(F.lit(1)).alias("total"),
        F.round(F.avg(amount), 0).alias("avg_amount"),
        F.round(F.min(amount), 0).alias("min_amount"),
        F.round(F.max(amount), 0).alias("max_amount"),
    )
    exact = exact_percentiles(
        df, channel, amount, {"median_amount": 0.5, "p95_amount": 0.95}, share
    ).withColumns({c: F.round(c, 0) for c in ("median_amount", "p95_amount")})
    return (
        lookup(_with_share(counted), exact, [channel])
        .select(
            channel,
            "total",
            "pct",
            "avg_amount",
            "min_amount",
            "max_amount",
            "median_amount",
            "p95_amount",
        )
        .orderBy(F.desc("total"), channel)
    )


def profile_by_city(df: DataFrame, city: str = "city", amount: str = "amount") -> DataFrame:
    """Count, share, mean and volume in millions per city, largest first."""
    counted = df.groupBy(city).agg(
        F.count(F.lit(1)).alias("total"),
        F.round(F.avg(amount), 0).alias("avg_amount"),
        (F.sum(amount) / 1e6).alias("volume_millions"),
    )
    return (
        _with_share(counted)
        .select(city, "total", "pct", "avg_amount", "volume_millions")
        .orderBy(F.desc("total"), city)
    )


def activity_by_hour(df: DataFrame, ts: str = "ts", amount: str = "amount") -> DataFrame:
    """Transactions and mean amount per hour of the day."""
    return (
        df.groupBy(F.hour(ts).alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.round(F.avg(amount), 0).alias("avg_amount"),
        )
        .orderBy("hour")
    )


def fraud_share(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows of a load, how many are fraud, and their share in percent."""
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(label)).alias("fraud")
    ).withColumn("pct_fraud", F.round(percent(F.col("fraud"), F.col("total")), 1))


def sample_by_hash(df: DataFrame, n: int, key: str = "transaction_id") -> DataFrame:
    """A repeatable sample: the n rows whose hashed key comes first."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
