"""Keys that hold a large share of the rows get their own way through the plan.

A key is *frequent* when it holds more than `min_rows` rows and more than one
`max_keys`-th of all rows. Fewer than `max_keys` keys can meet the second condition
whatever the data looks like, so the frequent keys always fit the driver and a broadcast.
Every other key holds at most max(min_rows, total / max_keys) rows, which one task
can sort. No row is dropped: each goes through exactly one of the two ways.

Whether there are frequent keys is asked of the data before the plan is built, by one job:
an aggregate with map-side combine that reads the key columns alone. Without any, the plan is
the plain one. Where the input is a long chain, `count_in` names a cheaper table to ask, such
as the rows before copies were removed: both ways give the same result for any key, so the
shares need not be those of the input itself. A key that is frequent in the input only counts as
ordinary then, which costs time and not rows, so name a table that has at least the input's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_ROWS = 1_000_000
MAX_KEYS = 100_000

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Share:
    """When a key counts as frequent, and in which rows that is counted (else in the input)."""

    min_rows: int = MIN_ROWS
    max_keys: int = MAX_KEYS
    count_in: DataFrame | None = None

    def in_input(self) -> Share:
        return replace(self, count_in=None)


@dataclass(frozen=True)
class Split:
    """Rows split by whether their key is frequent, once for all steps that follow.

    A step runs on both parts, so a chain of steps costs one question for the keys and one union.
    """

    whole: DataFrame  # the rows as they were split
    common: DataFrame  # rows of all keys that are not frequent
    frequent: DataFrame | None  # rows of the frequent keys, if there are any
    keys: DataFrame | None  # the frequent keys, fewer than max_keys rows
    by: tuple[str, ...]

    def apply(self, common: Transform, frequent: Transform) -> Split:
        """The split with `common` run on the rows of ordinary keys and `frequent` on the rest."""
        rest = None if self.frequent is None else frequent(self.frequent)
        return replace(self, common=common(self.common), frequent=rest)

    def transform(self, step: Callable[..., Split], *args, **kwargs) -> Split:
        return step(self, *args, **kwargs)

    def rows(self) -> DataFrame:
        return self.common if self.frequent is None else self.common.unionByName(self.frequent)

    def look_up(self, side: DataFrame) -> Split:
        """Add the columns of `side`, one row per key: by shuffle, and by broadcast for the few frequent keys."""
        return self.apply(
            lambda df: lookup(df, side, self.by),
            lambda df: lookup(df, F.broadcast(lookup(side, self.keys, self.by, "left_semi")), self.by),
        )


def lookup(rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join `side` to `rows` on `keys`, NULL matching NULL as in GROUP BY."""
    taken = {k: f"_side_{k}" for k in keys}
    side = side.withColumnsRenamed(taken)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(s)) for k, s in taken.items()])
    return rows.join(side, on, how).drop(*taken.values())


def frequent_keys(df: DataFrame, keys: Sequence[str], share: Share) -> DataFrame:
    """The frequent keys as a DataFrame; fewer than share.max_keys rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1))).scalar()  # reads no column
    return counts.where(
        (F.col("_n") > share.min_rows) & (F.col("_n") > total / share.max_keys)
    ).select(*keys)


def split_by_share(df: DataFrame, keys: Sequence[str], share: Share = Share()) -> Split:
    """Split the rows by whether their key is frequent."""
    frequent = frequent_keys(df if share.count_in is None else share.count_in, keys, share)
    found = frequent.collect()  # bounded by share.max_keys, see above
    if not found:
        return Split(df, df, None, None, tuple(keys))
    few = F.broadcast(df.sparkSession.createDataFrame(found, frequent.schema))
    return Split(
        whole=df,
        common=lookup(df, few, keys, "left_anti"),
        frequent=lookup(df, few, keys, "left_semi"),
        keys=few,
        by=tuple(keys),
    )


def by_share(
    df: DataFrame,
    keys: Sequence[str],
    common: Transform,
    frequent: Transform,
    share: Share = Share(),
) -> DataFrame:
    """Run `common` on the rows of ordinary keys, `frequent` on the rest; same columns out."""
    return split_by_share(df, keys, share).apply(common, frequent).rows()


def lookup_by_share(
    rows: DataFrame, side: DataFrame, keys: Sequence[str], share: Share = Share()
) -> DataFrame:
    """Left lookup of one `side` row per key that a single key cannot overload.

    The rows of frequent keys meet a broadcast of their few `side` rows; all others
    are joined by a shuffle on the keys.
    """
    return split_by_share(rows, keys, share).look_up(side).rows()
