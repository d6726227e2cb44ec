"""Whether data of one schema can be kept under another, field by field, and how many values could not.

A change is *widened* if every value of the old type is a value of the new one, *narrowed* if some may
not be, *lost* if the field is gone or of another kind, and *added* if it is new. Structs are compared by field
name, arrays by their elements, maps by keys and values.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Digits that whole numbers of these types need, and digits that are exact in floating point.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
EXACT = {T.FloatType: 7, T.DoubleType: 15}
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
TEXTS = (T.StringType, T.CharType, T.VarcharType)
#: Counts, within a value of the old type, what a leaf gives 1 for.
Count = Callable[[Column, Callable[[Column], Column]], Column]


class Change(NamedTuple):
    """A field by path (`a.b`, `a[]`, `a{key}`, `a{value}`), its types and what became of it."""

    path: str
    old: T.DataType | None
    new: T.DataType | None
    verdict: str
    count: Count | None = None


def leaf_verdict(old: T.DataType, new: T.DataType) -> str:
    """What becomes of values of one type that has no parts under another."""
    if old == new:
        return "same"
    if isinstance(new, TEXTS):
        if isinstance(old, (T.BinaryType, T.VariantType, T.ArrayType, T.MapType, T.StructType)):
            return "lost"
        return "widened" if type(new) is T.StringType else "narrowed"
    if isinstance(old, T.NumericType) and isinstance(new, T.NumericType):
        return "widened" if _holds(old, new) else "narrowed"
    if isinstance(old, TIMES) and isinstance(new, TIMES):
        return "widened" if isinstance(old, T.DateType) else "narrowed"
    if isinstance(old, TEXTS) and isinstance(new, (T.NumericType, T.BooleanType, *TIMES)):
        return "narrowed"
    return "lost"


def _holds(old: T.DataType, new: T.DataType) -> bool:
    """Whether each number of the old type is one of the new type."""
    if isinstance(old, (T.FloatType, T.DoubleType)):
        return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)
    whole, scale = (old.precision - old.scale, old.scale) if isinstance(old, T.DecimalType) else (DIGITS[type(old)], 0)
    if isinstance(new, T.DecimalType):
        return new.precision - new.scale >= whole and new.scale >= scale
    if isinstance(old, T.DecimalType):  # a binary fraction is not a decimal one
        return scale == 0 and whole < DIGITS.get(type(new), EXACT.get(type(new), 0) + 1)
    return whole <= EXACT[type(new)] if type(new) in EXACT else whole <= DIGITS[type(new)]


def compare_types(old: T.DataType, new: T.DataType, path: str = "", count: Count | None = None) -> list[Change]:
    """The changes between two types, in the order of the old one; parts of what is lost or added are not listed."""
    count = count or (lambda value, leaf: leaf(value))
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        found = []
        for f in old.fields:
            at = f"{path}.{f.name}" if path else f.name
            inner = _field(count, f.name)
            if f.name not in new.names:
                found.append(Change(at, f.dataType, None, "lost", inner))
            else:
                found += compare_types(f.dataType, new[f.name].dataType, at, inner)
        fresh = [f for f in new.fields if f.name not in old.names]
        return found + [Change(f"{path}.{f.name}" if path else f.name, None, f.dataType, "added") for f in fresh]
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return compare_types(old.elementType, new.elementType, f"{path}[]", _elements(count, lambda value: value))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        keys = compare_types(old.keyType, new.keyType, f"{path}{{key}}", _elements(count, F.map_keys))
        return keys + compare_types(old.valueType, new.valueType, f"{path}{{value}}", _elements(count, F.map_values))
    return [Change(path, old, new, leaf_verdict(old, new), count)]


def _field(outer: Count, name: str) -> Count:
    return lambda value, leaf: outer(value, lambda inner: leaf(inner.getField(name)))


def _elements(outer: Count, listed: Callable[[Column], Column]) -> Count:
    def count(value: Column, leaf: Callable[[Column], Column]) -> Column:
        def all_of(inner: Column) -> Column:
            ones = F.transform(listed(inner), lambda x: leaf(x).cast("long"))
            return F.coalesce(F.aggregate(ones, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long"))

        return outer(value, all_of)

    return count


def _not_kept(change: Change) -> Callable[[Column], Column]:
    """1 for a value that the new type cannot hold: a text that cannot be read, anything else that does not come back as it was."""
    old, new = change.old, change.new
    if change.verdict == "lost":
        return lambda value: value.isNotNull().cast("long")
    if change.verdict != "narrowed":
        return lambda value: F.lit(0).cast("long")
    if isinstance(old, TEXTS) and not isinstance(new, TEXTS):
        return lambda value: (value.isNotNull() & value.try_cast(new).isNull()).cast("long")
    return lambda value: (value.isNotNull() & ~value.try_cast(new).try_cast(old).eqNullSafe(value)).cast("long")


def compatibility(df: DataFrame, new: T.StructType) -> DataFrame:
    """(path, old_type, new_type, verdict, n_values, n_lost) of rows that are to be kept under another schema.

    All counts come from one aggregate over the rows. Values are those that are not null; a field that is new has none.
    """
    changes = compare_types(df.schema, new)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])

    def total(change: Change, leaf: Callable[[Column], Column]) -> Column:
        if change.count is None:
            return F.lit(0).cast("long")
        return F.coalesce(F.sum(change.count(row, leaf)), F.lit(0).cast("long"))

    told = [
        F.struct(
            F.lit(c.path).alias("path"),
            F.lit(c.old and c.old.simpleString()).cast("string").alias("old_type"),
            F.lit(c.new and c.new.simpleString()).cast("string").alias("new_type"),
            F.lit(c.verdict).alias("verdict"),
            total(c, lambda value: value.isNotNull().cast("long")).alias("n_values"),
            total(c, _not_kept(c)).alias("n_lost"),
        )
        for c in changes
    ]
    return df.agg(F.array(*told).alias("changes")).select(F.inline("changes"))


def compatible(old: T.StructType, new: T.StructType) -> bool:
    """Whether every value of the old schema is one of the new; runs no job."""
    return all(c.verdict not in ("narrowed", "lost") for c in compare_types(old, new))
