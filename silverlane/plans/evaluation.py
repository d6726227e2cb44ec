"""What the detectors found, and how good they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlane.functions.risk import level_name, percent, severity
from silverlane.operators import detect
from silverlane.operators.skew import Share


def detector_metrics(gold: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Counts, precision, recall and F1 in one pass; 0 where a ratio has no denominator.

    F1 comes from the unrounded ratios and is rounded once.
    """
    alert, fraud = F.col("alert"), F.col(label)
    counted = gold.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(alert).alias("alerts"),
        F.count_if(alert & fraud).alias("true_positives"),
        F.count_if(~alert & fraud).alias("false_negatives"),
        F.count_if(F.col("zscore_alert")).alias("zscore_alerts"),
        F.count_if(F.col("frequency_alert")).alias("frequency_alerts"),
    )
    found, missed = F.col("true_positives"), F.col("false_negatives")
    precision = percent(found, F.col("alerts"))
    recall = percent(found, found + missed)
    return counted.select(
        "total",
        "alerts",
        F.round(percent(F.col("alerts"), F.col("total")), 1).alias("pct_alerts"),
        "true_positives",
        (F.col("alerts") - found).alias("false_positives"),
        "false_negatives",
        F.round(precision, 1).alias("precision"),
        F.round(recall, 1).alias("recall"),
        # 2PR/(P+R) written with counts: 2TP / (alerts + TP + FN)
        F.round(percent(2 * found, F.col("alerts") + found + missed), 1).alias("f1"),
        "zscore_alerts",
        "frequency_alerts",
    )


def alerts_by_level_channel(gold: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Alerts per level and channel, the most severe level first."""
    return (
        gold.where("alert")
        .groupBy("risk_level", "channel")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col(label)).alias("fraud"),
            F.round(F.avg("amount"), 0).alias("avg_amount"),
        )
        .orderBy(F.desc(severity("risk_level")), F.desc("total"), "channel")
    )


def top_alerted_users(gold: DataFrame, k: int = 10) -> DataFrame:
    """The k users with the most alerts, with their worst level and the city of the first."""
    return (
        gold.where("alert")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_alerts"),
            F.count_if(F.col("zscore_alert")).alias("zscore_alerts"),
            F.count_if(F.col("frequency_alert")).alias("frequency_alerts"),
            F.round(F.max("amount"), 0).alias("max_amount"),
            level_name(F.max(severity("risk_level"))).alias("max_risk_level"),
            F.min(F.struct("ts", "transaction_id", "city"))["city"].alias("city"),
        )
        .orderBy(F.desc("total_alerts"), "user_id")
        .limit(k)
    )


def compare_zscore_versions(
    df: DataFrame,
    threshold: float = detect.Z_THRESHOLD,
    user: str = "user_id",
    amount: str = "amount",
    channel: str = "channel",
    share: Share = Share(),
) -> DataFrame:
    """Alerts without (v1) and with (v2) the channel fallback, and their difference.

    The statistics are attached once and both versions judged from them in one pass.
    """
    plain = detect.is_outlier(amount, "user_avg", "user_std", threshold)
    extended = detect.is_outlier_or_channel(amount, threshold)
    judged = detect.add_both_stats(df, user, amount, channel, share).select(
        plain.alias("v1"), extended.alias("v2")
    )
    return judged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("v1").alias("n_v1"),
        F.count_if("v2").alias("n_v2"),
    ).withColumns(
        {
            "n_extra": F.col("n_v2") - F.col("n_v1"),
            "same_type": F.lit(judged.schema["v1"].dataType == judged.schema["v2"].dataType),
        }
    )


def users_with(gold: DataFrame, evidence: Column) -> DataFrame:
    """Distinct users with a row that meets the condition."""
    return gold.where(evidence).select("user_id").distinct()
