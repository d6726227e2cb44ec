"""Domain schemas, the transactions table, and what can be discovered about them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from silverlane.governance.contract import literal, quoted

MADE_HERE = "silverlane.domain"  # marks schemas that `reset` may drop


def create_domains(
    spark: SparkSession, domains: Mapping[str, str], location: str | None = None
) -> None:
    """Create one schema per business domain, with its comment."""
    for name, comment in domains.items():
        at = "" if location is None else f" LOCATION {literal(f'{location}/{name}')}"
        spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS {quoted(name)} COMMENT {literal(comment)}{at} "
            f"WITH DBPROPERTIES ({literal(MADE_HERE)} = 'true')"
        )


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    comment: str = "",
    column_comments: Mapping[str, str] | None = None,
    partition_by: str = "layer",
) -> None:
    """Create a typed, commented, partitioned Parquet table.

    Parquet tables do not refuse NULL or broken values; writers guard them with `enforce`.
    """
    notes = column_comments or {}
    columns = ", ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}"
        + ("" if f.nullable else " NOT NULL")
        + (f" COMMENT {literal(notes[f.name])}" if f.name in notes else "")
        for f in schema.fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}) USING parquet "
        f"PARTITIONED BY ({quoted(partition_by)}) COMMENT {literal(comment)}"
    )


def discover_products(spark: SparkSession, schemas: Sequence[str] | None = None) -> DataFrame:
    """One row per table or view of the catalog: domain, name, type, description, created.

    Catalog entries only, so the loop is over metadata and never over rows.
    """
    names = [d.name for d in spark.catalog.listDatabases()]
    found = []
    for schema in sorted(n for n in names if schemas is None or n in schemas):
        for table in spark.catalog.listTables(schema):
            if table.isTemporary:
                continue
            described = describe(spark, f"{schema}.{table.name}")
            found.append(
                (
                    schema,
                    table.name,
                    table.tableType,
                    table.description,
                    described.get("created_time"),
                    described.get("last_access"),
                )
            )
    return spark.createDataFrame(
        sorted(found, key=lambda row: row[:2]),
        "domain string, data_product string, table_type string, description string, "
        "created_at string, last_access string",
    )


def describe(spark: SparkSession, table: str) -> dict:
    """What the catalog knows about one table."""
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)} AS JSON").first()
    return json.loads(row[0])


def schemas_table(spark: SparkSession) -> DataFrame:
    """Schemas and their comments, by name."""
    rows = sorted((d.name, d.description) for d in spark.catalog.listDatabases())
    return spark.createDataFrame(rows, "schema string, description string")


def check_environment(
    spark: SparkSession, schemas: Sequence[str], tables: Sequence[str]
) -> DataFrame:
    """(kind, name, present) for everything a run needs."""
    have = {d.name for d in spark.catalog.listDatabases()}
    rows = [("schema", s, s in have) for s in schemas]
    rows += [("table", t, spark.catalog.tableExists(t)) for t in tables]
    return spark.createDataFrame(rows, "kind string, name string, present boolean")


def reset(spark: SparkSession, schemas: Sequence[str]) -> list[str]:
    """Drop those of the schemas that `create_domains` made, with all they hold."""
    dropped = []
    for name in schemas:
        if not spark.catalog.databaseExists(name):
            continue
        details = spark.sql(f"DESCRIBE SCHEMA EXTENDED {quoted(name)}").collect()
        if any(MADE_HERE in str(row[1]) for row in details):
            spark.sql(f"DROP SCHEMA {quoted(name)} CASCADE")
            dropped.append(name)
    return dropped
