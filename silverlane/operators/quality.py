"""Quality rules: keep valid rows once, count what was refused and why, guard writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlane.functions.risk import percent
from silverlane.functions.rules import broken_rules, holds, table_constraints
from silverlane.schema import VALID_CHANNELS


def clean(
    df: DataFrame,
    on_bad_ts: str = "reject",
    key: str = "transaction_id",
    amount: str = "amount",
    channel: str = "channel",
    ts: str = "ts",
    channels: Sequence[str] = VALID_CHANNELS,
    user: str = "user_id",
    as_of: Column | None = None,
) -> DataFrame:
    """Valid rows with a typed time, one per key, stamped with the processing time.

    Rows without a key or a user, and rows from after `as_of` (by default now), are refused.
    on_bad_ts="reject" refuses rows whose time cannot be read, "keep" leaves it NULL.
    Rows are filtered before copies are removed, so a valid copy outlives an invalid one.
    """
    if on_bad_ts not in ("reject", "keep"):
        raise ValueError(f"on_bad_ts must be 'reject' or 'keep', not {on_bad_ts!r}")
    broken = broken_rules(amount, channel, ts, channels, key, user, as_of)
    if on_bad_ts == "keep":
        del broken["bad_ts"]
    valid = df.where(~reduce(lambda a, b: a | b, broken.values())).withColumn(
        ts, F.col(ts).try_cast("timestamp")
    )
    return first_copy(valid, key, ts).withColumn("processed_at", F.current_timestamp())


def first_copy(df: DataFrame, key: str, ts: str) -> DataFrame:
    """One row per key: the earliest, an unknown time last, then the smallest other columns.

    MIN over one struct combines on the map side, so however many copies a key has, each
    task sends one of them.
    """
    rest = [c for c in df.columns if c not in (key, ts)]
    copy = F.struct(F.col(ts).isNull().alias("_untimed"), F.col(ts), *rest)
    kept = df.groupBy(key).agg(F.min(copy).alias("_copy"))
    return kept.select(*[c if c == key else F.col(f"_copy.{c}").alias(c) for c in df.columns])


def reject_reasons(
    df: DataFrame,
    key: str = "transaction_id",
    channels: Sequence[str] = VALID_CHANNELS,
    as_of: Column | None = None,
) -> DataFrame:
    """(reason, n) over raw rows in one pass; a row may break several rules."""
    broken = broken_rules(channels=channels, key=key, as_of=as_of)
    valid = ~reduce(lambda a, b: a | b, broken.values())
    counted = df.agg(
        *[F.count_if(rule).alias(reason) for reason, rule in broken.items()],
        (F.count_if(valid) - _distinct(valid, key)).alias("duplicate"),
    )
    return counted.unpivot([], [*broken, "duplicate"], "reason", "n")


def quality_report(
    df: DataFrame, key: str = "transaction_id", channels: Sequence[str] = VALID_CHANNELS
) -> DataFrame:
    """What `clean` would refuse of these raw rows: counts and the share in percent."""
    valid = ~reduce(lambda a, b: a | b, broken_rules(channels=channels, key=key).values())
    counted = df.agg(
        F.count(F.lit(1)).alias("n_bronze"), _distinct(valid, key).alias("n_silver")
    )
    return _with_rejected(counted)


def compare_layers(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Row counts of two stored layers and their difference, negative if Silver holds more."""
    n_silver = silver.agg(F.count(F.lit(1))).scalar()
    return _with_rejected(
        bronze.agg(F.count(F.lit(1)).alias("n_bronze")).withColumn("n_silver", n_silver)
    )


def _with_rejected(counted: DataFrame) -> DataFrame:
    rejected = F.col("n_bronze") - F.col("n_silver")
    return counted.withColumn("n_rejected", rejected).withColumn(
        "pct_rejected", F.round(percent(rejected, F.col("n_bronze")), 1)
    )


def _distinct(valid: Column, key: str) -> Column:
    return F.count_distinct(F.when(valid, F.col(key)))


def channel_report(silver: DataFrame) -> DataFrame:
    """Per channel counts and amounts of validated rows; `invalid_amounts` must be 0."""
    return (
        silver.groupBy("channel")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.round(F.avg("amount"), 0).alias("avg_amount"),
            F.round(F.min("amount"), 0).alias("min_amount"),
            F.round(F.max("amount"), 0).alias("max_amount"),
            F.count_if(F.col("amount") <= 0).alias("invalid_amounts"),
        )
        .orderBy(F.desc("total"), "channel")
    )


def constraint_violations(
    df: DataFrame, constraints: Mapping[str, Column] | None = None
) -> DataFrame:
    """(constraint, violations): rows that do not meet each constraint, in one pass."""
    constraints = table_constraints() if constraints is None else constraints
    counted = df.agg(*[F.count_if(~holds(c)).alias(name) for name, c in constraints.items()])
    return counted.unpivot([], list(constraints), "constraint", "violations")


def enforce(df: DataFrame, constraints: Mapping[str, Column] | None = None) -> DataFrame:
    """The same rows, but a job that meets a violating row fails with the constraint's name.

    The check runs inside the writing job, so nothing is read twice, and since Spark commits
    the files of a job only when all its tasks are done, a refused write leaves nothing.
    """
    constraints = table_constraints() if constraints is None else constraints
    broken = F.lit(None).cast("string")
    for name, condition in reversed(constraints.items()):
        broken = F.when(~holds(condition), F.lit(name)).otherwise(broken)
    message = F.concat(F.lit("constraint violated: "), broken)
    return df.where(F.when(broken.isNotNull(), F.raise_error(message)).otherwise(F.lit(True)))
