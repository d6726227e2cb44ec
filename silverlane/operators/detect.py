"""Anomaly detectors over a user's transactions.

Each detector has two forms that give the same columns. For ordinary users it is a window
over the user. For users that hold a large share of all rows it is built from aggregates with
map-side combine and lookups, so that no task ever holds such a user's rows. Means and deviations
are one aggregate for all users, so they do not depend on who counts as frequent.

Detectors take rows or a `Split` of them by user and return the same. Chained detectors should be
given a split, which asks for the frequent users once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlane.functions.rules import holds
from silverlane.operators.skew import Share, Split, lookup, lookup_by_share, split_by_share

# Fixed defaults of the detectors.
Z_THRESHOLD = 3.0
WINDOW_S = 600
MAX_TX = 5

Rows = DataFrame | Split


def _on_split(df: Rows, user: str, share: Share, step: Callable[[Split], Split]) -> Rows:
    """Run a step on a split, or split the rows for it alone."""
    if isinstance(df, Split):
        return step(df)
    return step(split_by_share(df, [user], share)).rows()


def _both(step: Callable[[DataFrame], DataFrame]) -> Callable[[Split], Split]:
    return lambda split: split.apply(step, step)


# -- amount far above the user's own mean ------------------------------------------------


def zscore_alerts(
    df: Rows,
    threshold: float = Z_THRESHOLD,
    user: str = "user_id",
    amount: str = "amount",
    keep_stats: bool = True,
    share: Share = Share(),
) -> Rows:
    """Add `zscore_alert`: the amount lies over `threshold` sample deviations above the mean.

    One-sided, over all rows of the user. FALSE where the deviation is unknown or zero.
    """

    def judged(rows: DataFrame) -> DataFrame:
        out = rows.withColumn("zscore_alert", is_outlier(amount, "user_avg", "user_std", threshold))
        return out if keep_stats else out.drop("user_avg", "user_std")

    return _on_split(df, user, share, lambda split: _both(judged)(add_user_stats(split, user, amount)))


def add_user_stats(split: Split, user: str, amount: str) -> Split:
    """Add the user's mean and deviation, aggregated over the rows as they were split."""
    return split.look_up(stats_by(split.whole, user, amount, "user_avg", "user_std"))


def stats_by(df: DataFrame, key: str, amount: str, avg: str, std: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(amount).alias(avg), F.stddev_samp(amount).alias(std))


def is_outlier(amount: str, avg: str, std: str, threshold: float) -> Column:
    """Deviations from the mean against the threshold; FALSE without one, NULL without an amount."""
    spread = F.nullif(F.col(std), F.lit(0))
    deviations = (F.col(amount) - F.col(avg)) / spread
    return F.when(spread.isNull() | F.isnan(spread), False).otherwise(deviations > threshold)


# -- the same, falling back to the channel -----------------------------------------------


def zscore_fallback(
    df: DataFrame,
    threshold: float = Z_THRESHOLD,
    fallback: bool = True,
    user: str = "user_id",
    amount: str = "amount",
    channel: str = "channel",
    share: Share = Share(),
) -> DataFrame:
    """`zscore_alerts` judged by the channel where the user has no usable deviation.

    Returns the input and `zscore_alert` only.
    """
    if not fallback:
        return zscore_alerts(df, threshold, user, amount, False, share)
    out = add_both_stats(df, user, amount, channel, share)
    return out.withColumn("zscore_alert", is_outlier_or_channel(amount, threshold)).drop(*BOTH)


BOTH = ("user_avg", "user_std", "channel_avg", "channel_std")


def add_both_stats(
    df: DataFrame, user: str, amount: str, channel: str, share: Share = Share()
) -> DataFrame:
    """Add mean and deviation of the user and of the channel.

    Adaptive execution chooses the join with the channels, whose frequent values are broadcast.
    """
    out = add_user_stats(split_by_share(df, [user], share), user, amount).rows()
    stats = stats_by(df, channel, amount, "channel_avg", "channel_std")
    asked = replace(share, count_in=df if share.count_in is None else share.count_in)
    return lookup_by_share(out, stats, [channel], asked)


def is_outlier_or_channel(amount: str, threshold: float) -> Column:
    by_user, by_channel = (is_outlier(amount, f"{x}_avg", f"{x}_std", threshold) for x in ("user", "channel"))
    return F.when(F.col("user_std") > 0, by_user).otherwise(by_channel)


# -- many transactions within a trailing window ------------------------------------------


def frequency_alerts(
    df: Rows,
    window_s: int = WINDOW_S,
    max_tx: int = MAX_TX,
    user: str = "user_id",
    ts: str = "ts",
    keep_count: bool = True,
    share: Share = Share(),
) -> Rows:
    """Add `frequency_alert`: over `max_tx` rows of the user in the last `window_s` seconds.

    The window is inclusive and counts whole seconds; rows of the same second see each other,
    and rows without a time form a group of their own. A time without zone is read in the session's.
    """

    def judged(rows: DataFrame) -> DataFrame:
        out = rows.withColumn("frequency_alert", F.col("window_tx") > max_tx)
        return out if keep_count else out.drop("window_tx")

    def step(split: Split) -> Split:
        counted = split.apply(
            lambda d: add_count_windowed(d, window_s, user, ts),
            lambda d: add_by_second(d, count_by_second(d, window_s, user, ts), user, ts, share),
        )
        return _both(judged)(counted)

    return _on_split(df, user, share, step)


def add_count_windowed(df: DataFrame, window_s: int, user: str, ts: str) -> DataFrame:
    return (
        df.withColumn("_second", F.unix_timestamp(ts))
        .withColumn("window_tx", _trailing(F.count(F.lit(1)), [user], window_s))
        .drop("_second")
    )


def _trailing(counted: Column, keys: list[str], window_s: int) -> Column:
    """An additive count over the last `window_s` seconds, as a difference of running counts.

    Both frames only ever grow, so each row is added once per frame. A frame with two moving
    ends would be summed again for every row, which is quadratic within a burst.
    """
    ordered = Window.partitionBy(*keys).orderBy("_second")
    up_to_now = counted.over(ordered.rangeBetween(Window.unboundedPreceding, 0))
    before = counted.over(ordered.rangeBetween(Window.unboundedPreceding, -window_s - 1))
    # Rows without a time come first, so they are in both counts of every other row.
    return F.when(F.col("_second").isNull(), up_to_now).otherwise(
        up_to_now - F.coalesce(before, F.lit(0))
    )


def count_by_second(
    df: DataFrame, window_s: int, user: str, ts: str, top: str | None = None
) -> DataFrame:
    """(user, second, window_tx): the trailing count once per second in which a user has rows.

    Count per second first, then sum the seconds within slices of the user's time. A slice is
    as long as the window, so a trailing window ends in its own slice and reaches back into the
    one before: each second is given to its slice and to the next. A slice then holds at
    most two windows of seconds, however many rows the user has. `top` adds the largest value
    of that column per second.
    """
    kept = [] if top is None else [F.max(top).alias(top)]
    both = F.array(F.col("_home"), F.col("_home") + 1)
    seconds = (
        df.withColumn("_second", F.unix_timestamp(ts))
        .groupBy(user, "_second")
        .agg(F.count(F.lit(1)).alias("_n"), *kept)
        .withColumn("_home", F.floor(F.col("_second") / max(window_s, 1)))
        .withColumn(
            "_slice",
            F.explode(F.when(F.col("_home").isNull(), F.array("_home")).otherwise(both)),
        )
    )
    return (
        seconds.withColumn("window_tx", _trailing(F.sum("_n"), [user, "_slice"], window_s))
        .where(F.col("_slice").eqNullSafe(F.col("_home")))
        .drop("_slice", "_home", "_n")
    )


def add_by_second(
    df: DataFrame, seconds: DataFrame, user: str, ts: str, share: Share
) -> DataFrame:
    """Give each row what `seconds` holds for its user and second."""
    timed = df.withColumn("_second", F.unix_timestamp(ts))
    return lookup_by_share(timed, seconds, [user, "_second"], share.in_input()).drop("_second")


# -- confirmed fraud ---------------------------------------------------------------------


def label_confirmed(
    df: Rows,
    first: str = "zscore_alert",
    second: str = "frequency_alert",
    user: str = "user_id",
    label: str = "is_fraud",
    share: Share = Share(),
) -> Rows:
    """Label every row of a user who has some row with both alerts."""
    both = F.col(first) & F.col(second)

    def step(split: Split) -> Split:
        return split.apply(
            lambda d: label_windowed(d, both, user, label),
            lambda d: label_users(d, d.where(both), user, label),
        )

    return _on_split(df, user, share, step)


def label_windowed(df: DataFrame, evidence: Column, user: str, label: str) -> DataFrame:
    some = F.max(evidence).over(Window.partitionBy(user))
    return df.withColumn(label, F.col(user).isNotNull() & holds(some))


def label_users(df: DataFrame, evidence: DataFrame, user: str, label: str) -> DataFrame:
    """Label the rows of users that occur in `evidence`, broadcast: for rows of frequent users only, which are few."""
    found = evidence.select(user).distinct().withColumn("_some", F.lit(True))
    return (
        lookup(df, F.broadcast(found), [user])
        .withColumn(label, F.col(user).isNotNull() & holds(F.col("_some")))
        .drop("_some")
    )


def label_from(
    df: DataFrame,
    labels: DataFrame,
    key: str = "transaction_id",
    label: str = "is_fraud",
    share: Share | None = None,
) -> DataFrame:
    """Take the label from a table of (key, label) rows, e.g. of an investigation team.

    Give `share` if one key can hold many rows of `df`, as a user can; a transaction cannot.
    """
    side = labels.groupBy(key).agg(F.max(label).alias("_label"))
    rows = df.drop(label)
    joined = (
        lookup(rows, side, [key]) if share is None else lookup_by_share(rows, side, [key], share)
    )
    return joined.withColumn(label, holds(F.col("_label"))).drop("_label")


def same_output_type(left: DataFrame, right: DataFrame, column: str) -> bool:
    """Whether two versions of a transform give a column of one type; runs no job."""
    return left.schema[column].dataType == right.schema[column].dataType
