"""Landed JSON whose fields may grow: a new field becomes a column, a number widens, and every schema is kept.

Types form a lattice: long -> double -> string, structs field by field, arrays by element. The types of a batch
are one aggregate over its lines, combined before anything is shuffled. If they are more than the table has, the next
version of the schema is saved, and the batch is written with it. Rows stay as they were written, below the
version they were written with, and are brought to the latest when read. A struct or array never turns into text:
a value that does not fit it is kept as JSON in the column of other fields, as are fields whose names
would clash with another column.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.schema import CORRUPT, OTHER
from silverlane.sources.landing import LINE, MISSING, read_if_present

VERSION = "schema_version"
WRITE_ID = "write_id"
AROUND = T.StructType(
    [
        T.StructField(CORRUPT, T.StringType()),
        T.StructField(OTHER, T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
RESERVED = {*AROUND.names, VERSION, WRITE_ID}
NESTED = (T.StructType, T.ArrayType)


def plain(kind: T.DataType) -> T.DataType | None:
    """A type of the lattice for one found in JSON; None if nothing but nulls was found."""
    if isinstance(kind, T.StructType):
        found = {f.name: plain(f.dataType) for f in kind.fields}
        fields = [T.StructField(name, k) for name, k in found.items() if k is not None and not ("'" in name and '"' in name)]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        element = plain(kind.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, (T.DecimalType, T.DoubleType)):
        return T.DoubleType()
    return kind if isinstance(kind, (T.LongType, T.BooleanType)) else T.StringType()


def merged(old: T.DataType, new: T.DataType) -> T.DataType:
    """The least type that holds both; a struct or array stays one whatever else is found."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        found = {f.name: f for f in new.fields}
        fields = [T.StructField(f.name, merged(f.dataType, found.get(f.name, f).dataType)) for f in old.fields]
        names = {f.name.lower() for f in fields}
        for field in new.fields:
            if field.name.lower() not in names:  # one that differs in case only is kept aside
                names.add(field.name.lower())
                fields.append(T.StructField(field.name, fresh(field.dataType)))
        return T.StructType(fields)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged(old.elementType, new.elementType))
    if old == new or isinstance(old, NESTED):
        return old
    if {type(old), type(new)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def fresh(kind: T.DataType) -> T.DataType:
    """A type that was not there before, without names that differ in case only."""
    if isinstance(kind, T.StructType):
        return merged(T.StructType(), kind)
    return T.ArrayType(fresh(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


def types_of(lines: DataFrame) -> T.StructType:
    """The fields of all lines that are JSON objects, with the least types that hold them."""
    objects = lines.select(F.try_parse_json("value").alias("line")).where(F.schema_of_variant("line").startswith("OBJECT"))
    found = objects.agg(F.schema_of_variant_agg("line")).first()[0]
    # Names stand between backticks where they could be mistaken.
    ddl = re.sub(r"`[^`]*`|OBJECT<", lambda part: "STRUCT<" if part[0] == "OBJECT<" else part[0], found or "VOID")
    kind = T.DataType.fromDDL(ddl) if ddl.startswith("STRUCT<") and ddl != "STRUCT<>" else T.StructType()
    kind = T.StructType([f for f in kind.fields if f.name.lower() not in RESERVED])
    return plain(kind) or T.StructType()


def typed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of lines of JSON with these fields. Each line is parsed once.

    A value that does not fit its field is null there and kept as JSON with the fields the schema does not have.
    """
    line = lines.where(F.trim("value") != "").withColumn("_line", F.try_parse_json("value"))
    line = line.withColumn("_all", F.try_variant_get("_line", "$", "map<string,variant>"))

    def at(name: str) -> str:
        return f"$['{name}']" if "'" not in name else f'$["{name}"]'

    fields = {f.name: F.try_variant_get("_line", at(f.name), f.dataType.simpleString()) for f in schema.fields}
    rows = line.withColumn("_row", F.struct(*[c.alias(n) for n, c in fields.items()]) if fields else F.lit(None))
    fits = F.create_map(*[x for n in fields for x in (F.lit(n), F.col("_row")[n].isNotNull())]) if fields else F.create_map()

    def aside(name: Column, value: Column) -> Column:
        return ~F.is_variant_null(value) & ~F.coalesce(fits[name], F.lit(False))

    rest = F.map_filter("_all", aside)
    return rows.select(
        *[F.col("_row")[n].alias(n) for n in fields],
        F.when(F.col("_all").isNull(), F.col("value")).alias(CORRUPT),
        F.when(F.size(rest) > 0, F.to_json(F.transform_values(rest, lambda _, v: v.cast("string")))).alias(OTHER),
        "source_file",
        F.current_timestamp().alias("ingested_at"),
    )


def conformed(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value of one type as a later type that holds it."""
    if old == new:
        return value
    if isinstance(new, T.StructType):
        parts = {f.name: f.dataType for f in old.fields}
        fields = [
            (conformed(value[f.name], parts[f.name], f.dataType) if f.name in parts else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in new.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: conformed(x, old.elementType, new.elementType))
    return value.cast(new)


@dataclass(frozen=True)
class EvolvingTable:
    """Rows by schema version and write, and the schemas. One writer at a time."""

    spark: SparkSession
    root: str

    def schemas(self) -> dict[int, T.StructType]:
        """All versions, the first is 1; one small row each."""
        read = self.spark.read.schema("value string, version int").text
        known = read_if_present(self.spark, read, f"{self.root}/schemas", MISSING)
        if known.columns == MISSING.names:
            return {}
        return {r.version: T.StructType.fromJson(json.loads(r.value)) for r in known.orderBy("version").collect()}

    def take(self, lines: DataFrame, write_id: str) -> int:
        """Write lines of (value, source_file) as this write, in place of what it had; the version they are written with.

        If the write died after saving a schema, repeating it finds that schema and goes on with it.
        """
        known = self.schemas()
        version, old = max(known.items(), default=(0, T.StructType()))
        schema = merged(old, types_of(lines))
        if schema != old or not known:
            version += 1
            one = self.spark.createDataFrame([(schema.json(),)], LINE).coalesce(1)
            one.write.mode("overwrite").text(f"{self.root}/schemas/version={version}")
        rows = typed(lines, schema).withColumns({VERSION: F.lit(version), WRITE_ID: F.lit(write_id)})
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(VERSION, WRITE_ID).parquet(f"{self.root}/rows")
        return version

    def read(self, version: int | None = None) -> DataFrame:
        """All rows with the columns of a version, by default the latest, and those written later left out."""
        known = self.schemas()
        version = max(known, default=0) if version is None else version
        schema = known.get(version, T.StructType())
        own = [T.StructField(VERSION, T.IntegerType()), T.StructField(WRITE_ID, T.StringType())]
        every = self.spark.createDataFrame([], T.StructType([*schema.fields, *AROUND.fields, *own]))
        for number, had in known.items():
            if number > version:
                continue
            stored = T.StructType([*had.fields, *AROUND.fields, *own])
            path = f"{self.root}/rows/{VERSION}={number}"
            reader = self.spark.read.schema(stored).option("basePath", f"{self.root}/rows")
            rows = read_if_present(self.spark, reader.parquet, path, stored)
            names = set(had.names)
            columns = [
                (conformed(F.col(f"`{f.name}`"), had[f.name].dataType, f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema.fields
            ]
            every = every.union(rows.select(*columns, *AROUND.names, VERSION, WRITE_ID))
        return every

    def changes(self) -> DataFrame:
        """(version, column, type) of every schema, to see what came when."""
        rows = [(n, f.name, f.dataType.simpleString()) for n, schema in self.schemas().items() for f in schema.fields]
        return self.spark.createDataFrame(rows, "version int, column string, type string")
