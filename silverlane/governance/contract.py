"""The contract of a data product, kept with the table as properties and comments."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = "contract."


@dataclass(frozen=True)
class Contract:
    """Who owns a data product and what its users may rely on."""

    product_id: str
    domain: str
    owner_team: str
    owner_email: str
    sla_freshness: str
    sla_availability: str
    quality_tests: str
    classification: str
    pii_columns: str
    regulatory: str
    retention_days: str
    version: str
    status: str


def quoted(name: str) -> str:
    """A dotted name with every part quoted as an identifier."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def literal(text: str) -> str:
    """A text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_contract(
    spark: SparkSession,
    table: str,
    contract: Contract,
    comment: str | None = None,
    column_comments: Mapping[str, str] | None = None,
) -> None:
    """Store the contract, the table comment and the column comments in the catalog.

    Spark cannot change the comment of a partition column; give that one to `create_table`.
    """
    properties = ", ".join(
        f"{literal(PREFIX + key)} = {literal(value)}" for key, value in asdict(contract).items()
    )
    spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ({properties})")
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {quoted(table)} IS {literal(comment)}")
    noted = {c.name: c.description for c in spark.catalog.listColumns(table)}
    for column, text in (column_comments or {}).items():
        if noted.get(column) == text:
            continue
        spark.sql(
            f"ALTER TABLE {quoted(table)} ALTER COLUMN {quoted(column)} COMMENT {literal(text)}"
        )


def read_contract(spark: SparkSession, table: str) -> DataFrame:
    """(property, value) of the contract a table carries."""
    return (
        spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}")
        .where(F.startswith("key", F.lit(PREFIX)))
        .select(F.expr(f"substr(key, {len(PREFIX) + 1})").alias("property"), "value")
        .orderBy("property")
    )


def column_documentation(spark: SparkSession, table: str) -> DataFrame:
    """(column, type, comment) in table order."""
    return spark.createDataFrame(
        [(c.name, c.dataType, c.description) for c in spark.catalog.listColumns(table)],
        "column string, type string, comment string",
    )
