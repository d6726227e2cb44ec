"""Summaries that can be kept for every write and merged later, instead of reading its rows again.

Percentiles come from KLL sketches, whose rank error is bounded whatever the values are; distinct counts, also of
unions, intersections and differences of writes, from theta sketches, which are exact up to their size.
A sketch is some kilobytes, however many rows it stands for, and is combined on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a KLL sketch, and the rank error to expect of it with great certainty.
KLL_SIZE = 800
RANK_ERROR = 0.01
#: Logarithm of the size of a theta sketch: it is exact up to so many distinct values.
THETA_LOG_SIZE = 12


def amount_sketches(rows: DataFrame, *keys: str, amount: str = "amount", size: int = KLL_SIZE) -> DataFrame:
    """(keys, sketch) of the amounts that are not null; a table to be kept, such as by write and channel."""
    return rows.where(F.col(amount).isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(amount, F.lit(size)).alias("sketch"))


def quantiles_of(sketches: DataFrame, by: str, wanted: Mapping[str, float]) -> DataFrame:
    """(by, total, one column for each wanted rank) of sketches merged by one of their keys."""
    merged = sketches.groupBy(by).agg(F.kll_merge_agg_double("sketch").alias("_all"))
    ranks = {name: F.kll_sketch_get_quantile_double("_all", F.lit(rank)) for name, rank in wanted.items()}
    return merged.select(by, F.kll_sketch_get_n_double("_all").alias("total"), *[c.alias(n) for n, c in ranks.items()])


def rank_errors(rows: DataFrame, found: DataFrame, by: str, wanted: Mapping[str, float], amount: str = "amount") -> DataFrame:
    """(by, total, one column for each wanted rank): how far the rank of each value found is from the one asked for.

    A value that occurs often has a range of ranks; the nearest of them counts. The values found are one row
    for each key and are looked up by adaptive execution; the rows are read once.
    """
    near = found.drop("total").withColumnsRenamed({by: "_by"} | {name: f"_{name}" for name in wanted})
    kept = rows.where(F.col(amount).isNotNull()).join(near, F.col(by).eqNullSafe(F.col("_by")))
    total = F.count(F.lit(1))

    def error(name: str, rank: float) -> Column:
        below, upto = F.count_if(F.col(amount) < F.col(f"_{name}")) / total, F.count_if(F.col(amount) <= F.col(f"_{name}")) / total
        return F.greatest(below - rank, rank - upto, F.lit(0.0)).alias(name)

    return kept.groupBy(by).agg(total.alias("total"), *[error(name, rank) for name, rank in wanted.items()])


def distinct_sketches(rows: DataFrame, value: str, *keys: str, log_size: int = THETA_LOG_SIZE) -> DataFrame:
    """(keys, sketch) of the distinct values that are not null; a table to be kept, such as by write."""
    return rows.groupBy(*keys).agg(F.theta_sketch_agg(value, F.lit(log_size)).alias("sketch"))


def compare_sets(sketches: DataFrame, key: str, first: object, second: object, log_size: int = THETA_LOG_SIZE) -> DataFrame:
    """One row for each way to combine two sets: (combined, n_distinct, relative_error).

    The error is 0 where the count is exact, else the standard error of an estimate of that size. All
    sketches of a key are merged first, so a set may be many writes.
    """
    side = [F.theta_union_agg(F.when(F.col(key) == F.lit(x), F.col("sketch")), F.lit(log_size)).alias(n) for n, x in (("_a", first), ("_b", second))]
    both = sketches.where(F.col(key).isin(first, second)).agg(*side)
    a, b = F.col("_a"), F.col("_b")
    ways = {
        "first": a,
        "second": b,
        "either": F.theta_union(a, b, F.lit(log_size)),
        "both": F.theta_intersection(a, b),
        "first only": F.theta_difference(a, b),
        "second only": F.theta_difference(b, a),
    }
    size = 1 << log_size
    estimated = F.greatest(F.theta_sketch_estimate(a), F.theta_sketch_estimate(b), F.theta_sketch_estimate(ways["either"])) > size
    one = F.array(*[F.struct(F.lit(n).alias("combined"), F.theta_sketch_estimate(c).alias("n_distinct")) for n, c in ways.items()])
    rows = both.select(F.explode(one).alias("way"), F.when(estimated, 1 / (size - 2) ** 0.5).otherwise(0.0).alias("relative_error"))
    return rows.select("way.combined", F.col("way.n_distinct").cast("long").alias("n_distinct"), "relative_error")
