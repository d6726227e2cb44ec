"""Who accessed which data product, from a log of catalog actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Actions that count as access.
ACTIONS = ("getTable", "selectFromTable", "createTable", "alterTable")


def access_audit(
    log: DataFrame,
    service: str,
    prefix: str,
    hours: int = 3,
    newest: int = 20,
    as_of: Column | None = None,
    actions: Sequence[str] = ACTIONS,
) -> DataFrame:
    """The newest accesses of the last hours to products under the prefix, by minute.

    `as_of` replaces the current time, so that a past state can be audited again.
    """
    now = F.current_timestamp() if as_of is None else as_of
    product = F.col("request_params")["table_full_name"]
    accessed = log.where(
        (F.col("service_name") == service)
        & F.col("action_name").isin(*actions)
        & F.startswith(product, F.lit(prefix))
        & (F.col("event_time") >= now - F.make_interval(hours=F.lit(hours)))
    )
    if as_of is not None:
        accessed = accessed.where(F.col("event_time") < now)
    email = F.col("user_identity.email")
    return (
        accessed.orderBy(F.desc("event_time"), email, "action_name", product)
        .limit(newest)
        .select(
            F.date_trunc("minute", "event_time").alias("minute"),
            email.alias("user_name"),
            "action_name",
            product.alias("data_product"),
        )
    )
