"""Tables whose rows carry the id, time and kind of the write they came with.

Rows are Parquet files partitioned by layer and write id. Repeating a write replaces the partitions of its
own id (dynamic partition overwrite), so a write that died half-way is repaired by doing it again.
A table with a key also has a narrow table of its keys, bucketed and sorted by their hash, from which an insert learns
what is there without reading a row and without shuffling a key that is stored.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.operators.quality import enforce
from silverlane.sources.landing import MISSING, read_if_present

WRITE_ID = "write_id"
WRITTEN_AT = "written_at"
OPERATION = "operation"
BUCKETS = 16
#: Keys of a batch, and their bytes, up to which it is sent to the stored keys instead of meeting them bucket by bucket.
SENT_KEYS = 1_000_000
SENT_BYTES = 64 << 20


@dataclass(frozen=True)
class WrittenTable:
    """Where a table lives, which columns it has and what its rows must meet. One writer at a time.

    `buckets` is fixed with the first insert; one bucket's keys should fit a task (some 100 MB).
    """

    spark: SparkSession
    root: str
    schema: T.StructType  # ends with `layer`, the first partition column
    constraints: Mapping[str, Column] | None = None
    key: str = "transaction_id"
    keys_folder: str = "keys"
    buckets: int = BUCKETS
    sent_keys: int = SENT_KEYS

    def read(self) -> DataFrame:
        """All rows, with the id, time and kind of their write."""
        told = [T.StructField(WRITTEN_AT, T.TimestampType()), T.StructField(OPERATION, T.StringType())]
        stored = T.StructType([*_nullable(self.schema), T.StructField(WRITE_ID, T.StringType()), *told])
        reader = self.spark.read.schema(stored)
        return read_if_present(self.spark, reader.parquet, f"{self.root}/rows", stored).select(stored.names)

    def written_by(self, write_id: str) -> DataFrame:
        """The rows of one write; only its partitions are read."""
        return self.read().where(F.col(WRITE_ID) == write_id)

    def as_of(self, time: dt.datetime) -> DataFrame:
        """The rows of all writes up to a time."""
        return as_of(self.read(), time)

    def write(self, df: DataFrame, write_id: str, at: dt.datetime | None = None, operation: str = "write") -> None:
        """These rows as the write of this id, refused whole if one violates a constraint. Its time is now, or the one given."""
        rows = df.select(self.schema.names)
        if self.constraints:
            rows = enforce(rows, self.constraints)
        time = F.current_timestamp() if at is None else F.lit(at)
        told = rows.withColumns({WRITE_ID: F.lit(write_id), WRITTEN_AT: time, OPERATION: F.lit(operation)})
        writer = told.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("layer", WRITE_ID).parquet(f"{self.root}/rows")

    def insert_absent(self, df: DataFrame, write_id: str, at: dt.datetime | None = None) -> int:
        """Write the rows whose key no other write holds; how many they were. The first writer of a key wins.

        Keys are compared with those of the key table, by hash first; NULL equals NULL. An empty batch is
        a write without rows.
        """
        inserted = Observation()
        new = absent(_hashed(df, self.key), self.keys().where(F.col(WRITE_ID) != write_id), self.key, self.sent_keys)
        self.write(new.observe(inserted, F.count(F.lit(1)).alias("n")), write_id, at, "insert")
        # Read back, so that the keys are those of the rows whatever happened to the batch.
        self._hold(_hashed(self.written_by(write_id).select(self.key, WRITE_ID), self.key))
        return inserted.get["n"]

    def keys(self) -> DataFrame:
        """(key, key_hash, write_id) of all rows."""
        return self.spark.table(self._key_table())

    def compact_keys(self, folder: str) -> WrittenTable:
        """The table with its keys rewritten to another folder, one write instead of many.

        Done now and then, as every insert adds a file to each bucket; not to be repeated for the writes it holds.
        """
        compacted = replace(self, keys_folder=folder)
        compacted._hold(self.keys().withColumn(WRITE_ID, F.lit("compacted")))
        return compacted

    def _key_table(self) -> str:
        """The name of the key table, which is made known to the catalog if it is not yet."""
        path = f"{self.root}/{self.keys_folder}"
        name = f"default.keys_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
        if not self.spark.catalog.tableExists(name):
            kind = self.schema[self.key].dataType.simpleString()
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} (`{self.key}` {kind}, key_hash BIGINT, {WRITE_ID} STRING) USING parquet "
                f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({WRITE_ID}) "
                f"CLUSTERED BY (key_hash) SORTED BY (key_hash) INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
            if read_if_present(self.spark, self.spark.read.schema("key_hash long").parquet, path, MISSING).columns != MISSING.names:
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")  # of an earlier session
        return name

    def _hold(self, keys: DataFrame) -> None:
        """Store keys, a file for each bucket and write, in place of what the same writes had."""
        dealt = keys.select(self.key, "key_hash", WRITE_ID).repartition(self.buckets, "key_hash")
        dealt.write.mode("overwrite").insertInto(self._key_table())


def _nullable(fields: Sequence[T.StructField]) -> list[T.StructField]:
    return [T.StructField(f.name, f.dataType) for f in fields]


def _hashed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("key_hash", F.xxhash64(key))


def absent(rows: DataFrame, known: DataFrame, key: str, sent_keys: int = SENT_KEYS) -> DataFrame:
    """Hashed rows whose key is not among the known ones, which are never shuffled.

    The keys of a small batch are counted and sent to the known ones, where they find those that are held; these
    are no more than the batch's and are sent back. A larger batch is dealt out by the buckets of the known keys.
    """
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(key).cast("string"))).alias("bytes")).first()
    if size.n <= sent_keys and (size.bytes or 0) <= SENT_BYTES:
        held = known.join(F.broadcast(_side(rows, key)), _same(key), "left_semi").select("key_hash", key)
        return rows.join(F.broadcast(_side(held, key)), _same(key), "left_anti")
    return rows.join(_side(known, key).hint("merge"), _same(key), "left_anti")


def _side(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col("key_hash").alias("_hash"), F.col(key).alias("_key"))


def _same(key: str) -> Column:
    """One hash and one key. Only the hash is a join key, as the buckets are of it alone."""
    both = F.coalesce(F.col(key) == F.col("_key"), F.col(key).isNull() & F.col("_key").isNull())
    return (F.col("key_hash") == F.col("_hash")) & both


def as_of(rows: DataFrame, time: dt.datetime) -> DataFrame:
    """The rows of all writes up to a time."""
    return rows.where(F.col(WRITTEN_AT) <= F.lit(time))


def history(rows: DataFrame) -> DataFrame:
    """(write_id, written_at, operation, n_rows) of the writes of a table, in order of time."""
    return rows.groupBy(WRITE_ID, WRITTEN_AT, OPERATION).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(WRITTEN_AT, WRITE_ID)


def compare_writes(
    rows: DataFrame, moments: Mapping[str, Sequence[str] | dt.datetime | None], amount: str = "amount"
) -> DataFrame:
    """(moment, total, avg_amount) of the writes each moment names, or up to its time, None for all. The rows are read once."""

    def member(named: Sequence[str] | dt.datetime | None) -> Column:
        if named is None:
            return F.lit(True)
        return F.col(WRITTEN_AT) <= F.lit(named) if isinstance(named, dt.datetime) else F.col(WRITE_ID).isin(*named)

    last = {name: member(named) for name, named in moments.items()}
    seen = F.array(*[F.when(member, F.lit(name)) for name, member in last.items()])
    return (
        rows.withColumn("moment", F.explode(F.array_compact(seen)))
        .groupBy("moment")
        .agg(F.count(F.lit(1)).alias("total"), F.round(F.avg(amount), 0).alias("avg_amount"))
    )


def audit_sample(rows: DataFrame, write_ids: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows processed of these writes, to show what was loaded."""
    return (
        rows.where(F.col(WRITE_ID).isin(*write_ids))
        .select("transaction_id", "user_id", "amount", "channel", "city", "ts", "processed_at")
        .orderBy("processed_at", "transaction_id")
        .limit(n)
    )
