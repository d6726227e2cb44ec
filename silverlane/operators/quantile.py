"""Exact percentiles per group without gathering a large group in one task.

The built-in `percentile` keeps every distinct value of a group in one buffer. That is right
for groups of ordinary size. A group with a large share of the rows is narrowed down instead:
count its rows per cell of the value range, keep the cells that hold a wanted rank, divide
those once more, and sort only the distinct values of the few cells left. Each step is a
count with map-side combine and each set of kept cells is small enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlane.operators.skew import Share, by_share, lookup

CELLS_PER_E = 1024  # cells while the value grows by the factor e
LN_BOUND = 746  # |ln(x)| is below this for every finite double except 0
SUBCELLS = 4096


def exact_percentiles(
    df: DataFrame,
    group: str,
    value: str,
    wanted: Mapping[str, float],
    share: Share = Share(),
) -> DataFrame:
    """One row per group with a column per entry of `wanted` (name -> probability).

    NULL values are left out; between two ranks the result is interpolated linearly.
    """

    def buffered(rows: DataFrame) -> DataFrame:
        return rows.groupBy(group).agg(
            *[F.percentile(value, p).alias(name) for name, p in wanted.items()]
        )

    return by_share(
        df.select(group, value),
        [group],
        buffered,
        lambda rows: _narrowed(rows, group, value, wanted),
        share,
    )


def _narrowed(df: DataFrame, group: str, value: str, wanted: Mapping[str, float]) -> DataFrame:
    ranks = _Ranks(wanted)
    rows = df.where(F.col(value).isNotNull()).withColumn("_cell", _cell(F.col(value)))

    counted = rows.groupBy(group, "_cell").agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi")
    )
    counted = counted.withColumns(
        {"_total": F.sum("_n").over(Window.partitionBy(group)), "_before": F.lit(0)}
    )
    cells = _keep(counted, [group], "_cell", ranks).drop("_n")

    # At most two cells per wanted percentile and frequent group: a bounded broadcast.
    inside = lookup(rows, F.broadcast(cells), [group, "_cell"], "inner").withColumn(
        "_sub", _subcell(F.col(value))
    )
    parent = [group, "_cell"]
    counted = inside.groupBy(*parent, "_total", "_before", "_sub").agg(
        F.count(F.lit(1)).alias("_n")
    )
    subcells = _keep(counted, parent, "_sub", ranks).drop("_n", "_total")

    left = lookup(
        inside.drop("_before"), F.broadcast(subcells), [*parent, "_sub"], "inner"
    )
    counted = left.groupBy(*parent, "_sub", "_total", "_before", value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    values = _keep(counted, [*parent, "_sub"], value, ranks)
    return values.groupBy(group).agg(
        *[ranks.interpolated(name, value).alias(name) for name in wanted]
    )


class _Ranks:
    """The 0-based ranks around each wanted percentile of `_total` values."""

    def __init__(self, wanted: Mapping[str, float]):
        self.position = {
            name: F.lit(float(p)) * (F.col("_total") - 1) for name, p in wanted.items()
        }

    def around(self, name: str) -> tuple[Column, Column]:
        return F.floor(self.position[name]), F.ceil(self.position[name])

    def touched(self) -> Column:
        """Whether the span of ranks [_before, _before + _n) holds a wanted one."""
        return reduce(
            lambda a, b: a | b, [_spans(r) for name in self.position for r in self.around(name)]
        )

    def interpolated(self, name: str, value: str) -> Column:
        low, high = self.around(name)
        at_low = F.max(F.when(_spans(low), F.col(value)))
        at_high = F.max(F.when(_spans(high), F.col(value)))
        position = F.max(self.position[name])
        below, above = F.floor(position), F.ceil(position)
        between = (above - position) * at_low + (position - below) * at_high
        return F.when(below == above, at_low).otherwise(between)


def _spans(rank: Column) -> Column:
    return (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))


def _keep(counted: DataFrame, parent: list[str], cell: str, ranks: _Ranks) -> DataFrame:
    """Cells that hold a wanted rank, `_before` moved to the number of values before them."""
    earlier = Window.partitionBy(*parent).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    return counted.withColumn("_before", start).where(ranks.touched())


def _cell(x: Column) -> Column:
    """A whole number that never falls as x grows: the logarithm in steps, by sign.

    The natural logarithm of the JVM is semi-monotonic, as are the steps after it.
    """
    step = F.floor(F.least(F.ln(F.abs(x)), F.lit(float(LN_BOUND))) * CELLS_PER_E)
    size = step + (LN_BOUND + 1) * CELLS_PER_E  # at least CELLS_PER_E, so above zero's cell
    largest = 3 * LN_BOUND * CELLS_PER_E
    return (
        F.when(F.isnan(x), F.lit(largest))
        .when(x > 0, size)
        .when(x < 0, -size)
        .otherwise(F.lit(0))
        .cast("long")
    )


def _subcell(x: Column) -> Column:
    """Equal steps between the smallest and largest value of the cell."""
    lo, hi = F.col("_lo"), F.col("_hi")
    return F.when(lo == hi, F.lit(0)).otherwise(F.floor((x - lo) / (hi - lo) * SUBCELLS)).cast("long")
