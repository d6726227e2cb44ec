"""Row filter and column mask by group membership.

Open-source Spark has no function that tells whether the user is in a group, so membership is
a table of (user_name, grp). The test for it does not depend on the row: Spark evaluates it
once per query, and on a table partitioned by layer the row filter prunes partitions. The mask
protects the view; who may read the table below it is a matter of file permissions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlane.governance.contract import literal, quoted

MASK = "***"


def belongs(members: DataFrame, groups: Sequence[str], user: str | None = None) -> Column:
    """Whether the user (by default the current one) is in one of the groups."""
    name = F.current_user() if user is None else F.lit(user)
    matching = members.where((F.col("user_name") == name) & F.col("grp").isin(*groups))
    return matching.agg((F.count(F.lit(1)) > 0).alias("member")).scalar()


def secured(
    df: DataFrame,
    members: DataFrame,
    privileged: Sequence[str] = ("compliance", "admins"),
    masked: Sequence[str] = ("device",),
    open_rows: Column | None = None,
    user: str | None = None,
) -> DataFrame:
    """What the user may see: open rows only and masked columns, or all if privileged."""
    allowed = belongs(members, privileged, user)
    visible = (F.col("layer") == "silver") if open_rows is None else open_rows
    return df.where(visible | allowed).withColumns(
        {c: F.when(allowed, F.col(c)).otherwise(F.lit(MASK)) for c in masked}
    )


def create_secured_view(
    spark: SparkSession,
    view: str,
    table: str,
    members_table: str,
    privileged: Sequence[str] = ("compliance", "admins"),
    masked: Sequence[str] = ("device",),
    open_rows: str = "layer = 'silver'",
    comment: str = "",
) -> None:
    """A permanent view that applies both controls to whoever reads it."""
    groups = ", ".join(literal(g) for g in privileged)
    allowed = (
        f"EXISTS (SELECT 1 FROM {quoted(members_table)} "
        f"WHERE user_name = current_user() AND grp IN ({groups}))"
    )
    columns = ", ".join(
        f"CASE WHEN {allowed} THEN {quoted(c)} ELSE {literal(MASK)} END AS {quoted(c)}"
        if c in masked
        else quoted(c)
        for c in spark.table(table).columns
    )
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(view)} COMMENT {literal(comment)} AS "
        f"SELECT {columns} FROM {quoted(table)} WHERE {open_rows} OR {allowed}"
    )


def check_masking(view: DataFrame, user: str | None = None) -> DataFrame:
    """What the user sees: rows, distinct devices and one of them."""
    return view.agg(
        F.count(F.lit(1)).alias("visible_rows"),
        F.count_distinct("device").alias("distinct_devices"),
        F.min("device").alias("sample_device"),
    ).select(
        (F.current_user() if user is None else F.lit(user)).alias("user_name"),
        "visible_rows",
        "distinct_devices",
        "sample_device",
    )
