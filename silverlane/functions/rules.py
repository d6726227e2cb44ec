"""The row rules of the quality contract, as named predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverlane.schema import VALID_CHANNELS


def broken_rules(
    amount: str = "amount",
    channel: str = "channel",
    ts: str = "ts",
    channels: Sequence[str] = VALID_CHANNELS,
    key: str = "transaction_id",
    user: str = "user_id",
    as_of: Column | None = None,
) -> dict[str, Column]:
    """Reason -> true where the row breaks that rule. A NULL never passes.

    `as_of` is the time from which on a row counts as from the future, by default now.
    """
    time = F.col(ts).try_cast("timestamp")
    return {
        "no_id": F.col(key).isNull(),
        "no_user": F.col(user).isNull(),
        "bad_amount": ~holds(F.col(amount) > 0),
        "bad_channel": ~holds(F.col(channel).isin(*channels)),
        "bad_ts": time.isNull(),
        "future_ts": holds(time > (F.current_timestamp() if as_of is None else as_of)),
    }


def holds(condition: Column) -> Column:
    """The condition with NULL read as not met."""
    return F.coalesce(condition, F.lit(False))


def table_constraints(
    as_of: Column | None = None, channels: Sequence[str] = VALID_CHANNELS
) -> dict[str, Column]:
    """Constraint name -> what every stored row must meet."""
    return {
        "transaction_id_present": F.col("transaction_id").isNotNull(),
        "user_id_present": F.col("user_id").isNotNull(),
        "amount_positive": F.col("amount") > 0,
        "channel_valid": F.col("channel").isin(*channels),
        "ts_not_future": F.col("ts") <= (F.current_timestamp() if as_of is None else as_of),
    }
