"""The most alerted users from counts kept for every write, without adding up all users.

Every write leaves a list of its users with what each adds to the report, sorted by the number of alerts. The
greatest totals are found by thresholds, in three reads:

1. The heads, the first k rows of each list. The k-th greatest sum over them is a floor: k users have as much.
2. A bar for every list, the bars together no higher than the floor. Whoever stays below the bar in all lists has
   less than the floor, so only rows that reach their bar are added up. A user's total is then known from below, and
   from above by the bars of the lists the user was not seen in.
3. All rows of the users whose total may be among the k greatest.

Each read is filtered before rows move, so long tails of users with few alerts stay where they are. The result is that of
the full aggregate, ties included; with fewer than k users the floor is 0 and all rows are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlane.functions.risk import level_name, severity
from silverlane.operators.skew import lookup
from silverlane.scratch import run_dir

#: Users, once counted, that may be sent to all tasks; more are met by shuffle.
MOST_SENT = 1_000_000
EXACT = "decimal(19,0)"


def alert_list(gold: DataFrame, write: str = "write_id") -> DataFrame:
    """(write, user_id, total_alerts, ...): what each user of each write adds to the report."""
    return (
        gold.where("alert")
        .groupBy(write, "user_id")
        .agg(
            F.count(F.lit(1)).alias("total_alerts"),
            F.count_if(F.col("zscore_alert")).alias("zscore_alerts"),
            F.count_if(F.col("frequency_alert")).alias("frequency_alerts"),
            F.max("amount").alias("max_amount"),
            F.max(severity("risk_level")).alias("severity"),
            F.min(F.struct("ts", "transaction_id", "city")).alias("first"),
        )
    )


def keep(lists: DataFrame, path: str, write: str = "write_id") -> None:
    """Adds lists to a table, sorted, so that a filter on the count skips files and row groups.

    They are dealt by ranges of count and user, so a long list is many files and no task has to hold it.
    """
    order = [F.col(write), F.desc("total_alerts"), F.col("user_id")]
    dealt = lists.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.write.mode("append").partitionBy(write).parquet(path)


def heads(lists: DataFrame, k: int, write: str = "write_id") -> DataFrame:
    """(write, user_id, total_alerts) of the first k rows of each list; tasks send no more than k a list."""
    place = F.row_number().over(Window.partitionBy(write).orderBy(F.desc("total_alerts"), "user_id"))
    return lists.select(write, "user_id", "total_alerts", place.alias("_place")).where(F.col("_place") <= k).drop("_place")


def floor_of(sums: DataFrame, k: int) -> int:
    """The k-th greatest of the column `known`, 0 if there are fewer."""
    greatest = sums.select("known").orderBy(F.desc("known")).limit(k).collect()
    return greatest[-1]["known"] if len(greatest) == k else 0


def bars(first: DataFrame, floor: int, write: str = "write_id") -> DataFrame:
    """(write, bar) from the heads: whole numbers, in proportion to the last count of each head, together at most `floor`."""
    last = first.groupBy(write).agg(F.min("total_alerts").cast(EXACT).alias("last"))
    everything = last.agg(F.sum("last").cast(EXACT).alias("everything"))  # one row
    dealt = last.crossJoin(F.broadcast(everything)).withColumn("floor", F.lit(floor).cast(EXACT))
    return dealt.select(write, F.expr("(last * floor) div everything").alias("bar"))


def above(lists: DataFrame, bar: DataFrame, write: str = "write_id") -> DataFrame:
    """(write, user_id, total_alerts, bar) of the rows that reach the bar of their list."""
    lowest = bar.agg(F.min("bar")).first()[0] or 0  # a number that the scan can filter by
    some = lists.select(write, "user_id", "total_alerts").where(F.col("total_alerts") >= lowest)
    return lookup(some, bar, [write]).where(F.col("total_alerts") >= F.col("bar"))


def bounded(reached: DataFrame, bar: DataFrame) -> DataFrame:
    """(user_id, known, most): bounds of the total of each user that reached a bar."""
    slack = F.greatest(F.col("bar") - 1, F.lit(0))  # what a list may hide of a user
    hidden = bar.agg(F.sum(slack)).scalar()
    summed = reached.groupBy("user_id").agg(F.sum("total_alerts").alias("known"), F.sum(slack).alias("_seen"))
    return summed.select("user_id", "known", (F.col("known") + hidden - F.col("_seen")).alias("most"))


def of_users(lists: DataFrame, users: DataFrame) -> DataFrame:
    """The rows of some users in all lists."""
    few = users.limit(MOST_SENT + 1).count() <= MOST_SENT
    return lookup(lists, F.broadcast(users) if few else users, ["user_id"], "left_semi")


def report(rows: DataFrame, k: int) -> DataFrame:
    """The k users with the most alerts, as `evaluation.top_alerted_users` has them."""
    return (
        rows.groupBy("user_id")
        .agg(
            F.sum("total_alerts").alias("total_alerts"),
            F.sum("zscore_alerts").alias("zscore_alerts"),
            F.sum("frequency_alerts").alias("frequency_alerts"),
            F.round(F.max("max_amount"), 0).alias("max_amount"),
            level_name(F.max("severity")).alias("max_risk_level"),
            F.min("first")["city"].alias("city"),
        )
        .orderBy(F.desc("total_alerts"), "user_id")
        .limit(k)
    )


def _written(rows: DataFrame, name: str) -> DataFrame:
    path = run_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def candidates(lists: DataFrame, k: int, write: str = "write_id") -> DataFrame:
    """(user_id) of all users whose total may be among the k greatest, ties included."""
    first = _written(heads(lists, k, write), "heads")
    floor = floor_of(first.groupBy("user_id").agg(F.sum("total_alerts").alias("known")), k)
    bar = _written(bars(first, floor, write), "bars")
    bounds = _written(bounded(above(lists, bar, write), bar), "bounds")
    return bounds.where(F.col("most") >= max(floor, floor_of(bounds, k))).select("user_id")


def top_users(spark: SparkSession, path: str, k: int = 10, write: str = "write_id") -> DataFrame:
    """The k users with the most alerts in all lists kept at `path`."""
    lists = spark.read.parquet(path)
    return report(of_users(lists, candidates(lists, k, write)), k)
