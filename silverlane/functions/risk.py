"""Risk score, level and severity as plain column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverlane.schema import RISK_LEVELS


def mean_of_flags(*flags: str) -> Column:
    """Share of the flags that are set: 0, 0.5 or 1 for two detectors."""
    total = reduce(lambda a, b: a + b, [F.col(f).cast("int") for f in flags])
    return total / F.lit(float(len(flags)))


def level_of(*flags: str) -> Column:
    """No flag, some, or all of them."""
    n = reduce(lambda a, b: a + b, [F.coalesce(F.col(f), F.lit(False)).cast("int") for f in flags])
    return level_name((n > 0).cast("int") + (n == len(flags)).cast("int"))


def severity(level: str) -> Column:
    """Position of a level in rising severity; the names do not sort that way."""
    ranked = F.when(F.col(level) == RISK_LEVELS[0], 0)
    for rank, name in enumerate(RISK_LEVELS[1:], start=1):
        ranked = ranked.when(F.col(level) == name, rank)
    return ranked


def level_name(rank: Column) -> Column:
    """The level with this severity."""
    named = F.when(rank == 0, RISK_LEVELS[0])
    for position, name in enumerate(RISK_LEVELS[1:], start=1):
        named = named.when(rank == position, name)
    return named


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as DOUBLE, and 0 where there is no whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(
        F.lit(100.0) * part.cast("double") / whole.cast("double")
    )
