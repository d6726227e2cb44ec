"""Silver to Gold: both detectors, the risk level and the confirmed-fraud label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.functions.risk import level_of, mean_of_flags
from silverlane.operators import detect
from silverlane.operators.skew import Share, lookup, split_by_share


def gold_alerts(
    silver: DataFrame,
    z_threshold: float = detect.Z_THRESHOLD,
    window_s: int = detect.WINDOW_S,
    max_tx: int = detect.MAX_TX,
    share: Share = Share(),
) -> DataFrame:
    """Score every Silver row. Parameters can be changed per run without touching code.

    The rows are split by user once, and all steps run on that split.
    """
    user, amount, ts = "user_id", "amount", "ts"
    both = F.col("zscore_alert") & F.col("frequency_alert")

    def flags(df: DataFrame) -> DataFrame:
        return df.withColumn(
            "zscore_alert", detect.is_outlier(amount, "user_avg", "user_std", z_threshold)
        ).withColumn("frequency_alert", F.col("window_tx") > max_tx)

    def common(df: DataFrame) -> DataFrame:
        return (
            df.transform(detect.add_count_windowed, window_s, user, ts)
            .transform(flags)
            .transform(detect.label_windowed, both, user, "is_fraud")
        )

    def frequent(df: DataFrame) -> DataFrame:
        # Some row has both alerts exactly if the largest amount of its second has them, so the
        # label is found among the seconds and the rows are joined once.
        seconds = detect.count_by_second(df, window_s, user, ts, top=amount)
        users = df.groupBy(user).agg(F.first("user_avg").alias("user_avg"), F.first("user_std").alias("user_std"))
        evidence = lookup(seconds, F.broadcast(users), [user]).transform(flags).where(both)  # frequent users only
        return (
            df.transform(detect.add_by_second, seconds.drop(amount), user, ts, share)
            .transform(flags)
            .transform(detect.label_users, evidence, user, "is_fraud")
        )

    typed = silver.drop("is_fraud").withColumn(ts, F.col(ts).try_cast("timestamp"))
    split = detect.add_user_stats(split_by_share(typed, [user], share), user, amount)
    scored = split.apply(common, frequent).rows()
    return (
        scored.withColumn("alert", F.col("zscore_alert") | F.col("frequency_alert"))
        .withColumn("score", mean_of_flags("zscore_alert", "frequency_alert"))
        .withColumn("risk_level", level_of("zscore_alert", "frequency_alert"))
        .withColumn("layer", F.lit("gold"))
        .withColumn("processed_at", F.current_timestamp())
    )


# What a run may set from outside, how its text is read, and the value if it is not given.
PARAMETERS = {
    "z_threshold": (float, detect.Z_THRESHOLD),
    "window_s": (int, detect.WINDOW_S),
    "max_tx": (int, detect.MAX_TX),
}


def run_parameters(given: Mapping[str, str]) -> dict[str, float | int]:
    """Typed detector parameters of a run; an empty or missing text means the default."""
    unknown = set(given) - set(PARAMETERS)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    return {
        name: read(given[name].strip()) if given.get(name, "").strip() else default
        for name, (read, default) in PARAMETERS.items()
    }


def replace_gold(
    path: str, silver: DataFrame, given: Mapping[str, str] | None = None, share: Share = Share()
) -> None:
    """Score Silver again and let the result take the place of all that is stored in `path`."""
    scored = gold_alerts(silver, **run_parameters(given or {}), share=share)
    scored.write.mode("overwrite").partitionBy("layer").parquet(path)
