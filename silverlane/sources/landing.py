"""The landing folder: JSON files as they arrive, read in batch or as a stream."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.schema import CORRUPT, OTHER, RAW

MAX_FILES_PER_TRIGGER = 500  # fixed value


LINEAGE = (
    T.StructField("source_file", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("layer", T.StringType()),
    T.StructField("is_fraud", T.BooleanType()),
)
LINE = T.StructType([T.StructField("value", T.StringType())])
MISSING = T.StructType([T.StructField("missing", T.BooleanType())])


def parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of lines of JSON, with the columns that say what did not fit and where each row came from.

    A line that is not JSON is kept whole in the corrupt-record column. Fields the schema does not have are
    kept as JSON in one text column; only lines with more names (a quote and a colon) than known fields found
    are parsed again for them. The fraud label is unknown at this point.
    """
    names = [n for n in schema.names if n not in (CORRUPT, OTHER)]
    fields = T.StructType([*(schema[n] for n in names), T.StructField(CORRUPT, T.StringType())])
    row = F.from_json("value", fields, {"columnNameOfCorruptRecord": CORRUPT})
    rest = F.map_filter(F.from_json("value", "map<string,string>"), lambda name, _: ~name.isin(*names))
    found = F.array_size(F.array_compact(F.array(*[F.when(row[n].isNotNull(), 1) for n in names])))
    more = F.regexp_count("value", F.lit(r"""["']\s*:""")) > found
    return lines.where(F.trim("value") != "").select(
        *[row[n].alias(n) for n in [*names, CORRUPT]],
        F.when(more, F.when(F.size(rest) > 0, F.to_json(rest))).alias(OTHER),
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("ingested_at"),
        F.lit("bronze").alias("layer"),
        F.lit(False).alias("is_fraud"),
    )


def read_landing(spark: SparkSession, path: str, schema: T.StructType = RAW) -> DataFrame:
    """All landed rows. A folder that does not exist yet gives none, like an empty one."""
    names = [n for n in schema.names if n not in (CORRUPT, OTHER)]
    extra = [T.StructField(CORRUPT, T.StringType()), T.StructField(OTHER, T.StringType())]
    out = T.StructType([*(schema[n] for n in names), *extra, *LINEAGE])
    return read_if_present(spark, lambda found: parsed(spark.read.text(found), schema), path, out)


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    saved_at: str | None = None,
) -> DataFrame:
    """The same as a stream of files not seen before; a folder that does not exist yet is made.

    The schema is the one given, or the one saved at `saved_at` (inferred and saved by the first run).
    """
    if read_if_present(spark, spark.read.text, path, MISSING).columns == MISSING.names:
        spark.createDataFrame([], LINE).coalesce(1).write.mode("append").text(path)
    if schema is None:
        schema = RAW if saved_at is None else infer_schema(spark, path, saved_at)
    lines = spark.readStream.schema(LINE).format("text").option("maxFilesPerTrigger", max_files_per_trigger)
    return parsed(lines.load(path), schema)


def read_if_present(
    spark: SparkSession, read: Callable[[str], DataFrame], path: str, schema: T.StructType
) -> DataFrame:
    """`read(path)`, or no rows if there is no such path; other failures are not hidden."""
    try:
        return read(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def infer_schema(spark: SparkSession, path: str, saved_at: str | None = None) -> T.StructType:
    """The types found in the landed files; saved if wanted, so that later runs use the same."""
    if saved_at is None:
        return spark.read.json(path).schema
    text = T.StructType([T.StructField("value", T.StringType())])
    saved = read_if_present(spark, spark.read.text, saved_at, text).first()
    if saved is not None:
        return T.StructType.fromJson(json.loads(saved["value"]))
    schema = spark.read.json(path).schema
    spark.createDataFrame([(schema.json(),)], text).write.text(saved_at)
    return schema


def land(df: DataFrame, path: str) -> None:
    """Write rows as JSON files, as a producer would."""
    df.write.mode("append").json(path)


def schema_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A schema as rows: column, type, nullable."""
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields],
        "column string, type string, nullable boolean",
    )


FILES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("size_kb", T.DoubleType()),
        T.StructField("modified_at", T.TimestampType()),
    ]
)


def inventory(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Name and size of every file, by name; the contents are not read. A missing folder has none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return read_if_present(
        spark,
        lambda found: files.option("recursiveFileLookup", "true")
        .load(found)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("name"),
            (F.col("length") / 1024).alias("size_kb"),
            F.col("modificationTime").alias("modified_at"),
        ),
        path,
        FILES,
    ).orderBy("name")


def inventory_total(files: DataFrame) -> DataFrame:
    """How many files an inventory holds and how large they are together."""
    return files.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("size_kb"), F.lit(0.0)).alias("total_kb"),
    )
