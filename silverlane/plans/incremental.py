"""Gold that goes on from what is known, instead of from all rows.

Every write leaves, beside its rows, two small tables: for each user the moments of the amounts (number, mean, sum of
squared deviations, smallest and largest), and for each user and second the number of rows and the largest
amount. Moments of writes are merged by the pairwise formula, seconds are added up, and both together hold all that a
score depends on: a row has both alerts only if the largest amount of its second has them. So rows are scored
by looking up, and only rows of users that a write touched are read again, as all tables are partitioned
by a hash of the user. Writes may come in any order, late rows included.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.functions.rules import holds
from silverlane.functions.risk import level_of, mean_of_flags
from silverlane.operators import detect
from silverlane.operators.skew import Share, lookup, lookup_by_share
from silverlane.sources.landing import read_if_present

BUCKET = "user_bucket"
WRITE_ID = "write_id"
BUCKETS = 64
USER, AMOUNT, TS = "user_id", "amount", "ts"
LAYOUT = [T.StructField(BUCKET, T.IntegerType()), T.StructField(WRITE_ID, T.StringType())]
MOMENTS = [T.StructField("n", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("mean", "m2", "low", "high")]]
SECONDS = [T.StructField("_second", T.LongType()), T.StructField("_n", T.LongType()), T.StructField("top", T.DoubleType())]


def moments_by(rows: DataFrame, *keys: str) -> DataFrame:
    """Number, mean, sum of squared deviations and bounds of the amounts, by these columns."""
    amount = F.col(AMOUNT)
    return rows.groupBy(*keys).agg(
        F.count(amount).alias("n"),
        F.avg(amount).alias("mean"),
        (F.var_pop(amount) * F.count(amount)).alias("m2"),
        F.min(amount).alias("low"),
        F.max(amount).alias("high"),
    )


def merged_moments(moments: DataFrame, *keys: str) -> DataFrame:
    """The same of several parts together. A group is a row for each part it is in.

    Parts are merged two at a time, in order of their write: n = a + b, d = the distance of the means,
    mean = mean_a + d b / n, m2 = m2_a + m2_b + d^2 a b / n.
    """
    parts = moments.where("n > 0").withColumn("part", F.struct(WRITE_ID, "n", "mean", "m2"))

    def pair(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        mean = a["mean"] + apart * b["n"] / n
        m2 = a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n
        return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    whole = F.aggregate(F.sort_array(F.collect_list("part")), none, pair)
    found = parts.groupBy(*keys).agg(whole.alias("all"), F.min("low").alias("low"), F.max("high").alias("high"))
    return found.select(*keys, "all.n", "all.mean", "all.m2", "low", "high")


def trailing(seconds: DataFrame, window_s: int) -> DataFrame:
    """(bucket, user, second, window_tx, top) from the counts of all writes.

    Each second is given to the slice of time it lies in and the next, a slice being as long as the window, so
    no group is larger than two windows of seconds, whoever the user is.
    """
    one = seconds.groupBy(BUCKET, USER, "_second").agg(F.sum("_n").alias("_n"), F.max("top").alias("top"))
    home = F.floor(F.col("_second") / max(window_s, 1))
    near = F.when(F.col("_second").isNull(), F.array(home)).otherwise(F.array(home, home + 1))
    sliced = one.withColumn("_home", home).withColumn("_slice", F.explode(near))
    counted = sliced.withColumn("window_tx", detect._trailing(F.sum("_n"), [BUCKET, USER, "_slice"], window_s))
    return counted.where(F.col("_slice").eqNullSafe(F.col("_home"))).drop("_slice", "_home", "_n")


@dataclass(frozen=True)
class ScoreStore:
    """Rows, moments and seconds of a table, by user bucket and write. One writer at a time.

    `buckets` is fixed with the first write; a write rescans the buckets of its users.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    buckets: int = BUCKETS

    def add(self, rows: DataFrame, write_id: str) -> None:
        """Store these rows as the write of this id, in place of what it had; then what scores need of them."""
        bucket = F.pmod(F.xxhash64(USER), F.lit(self.buckets)).cast("int")
        typed = rows.select(self.schema.names).withColumn(TS, F.col(TS).try_cast("timestamp"))
        self._replace("rows", typed.withColumns({BUCKET: bucket, WRITE_ID: F.lit(write_id)}))
        own = self.rows().where(F.col(WRITE_ID) == write_id)  # as written, whatever happened to the input
        self._replace("moments", moments_by(own, USER, BUCKET, WRITE_ID))
        second = own.withColumn("_second", F.unix_timestamp(TS))
        counted = second.groupBy(USER, "_second", BUCKET, WRITE_ID)
        self._replace("seconds", counted.agg(F.count(F.lit(1)).alias("_n"), F.max(AMOUNT).alias("top")))

    def rows(self) -> DataFrame:
        fields = [T.StructField(f.name, T.TimestampType() if f.name == TS else f.dataType) for f in self.schema.fields]
        return self._load("rows", fields)

    def moments(self) -> DataFrame:
        return self._load("moments", [self.schema[USER], *MOMENTS])

    def seconds(self) -> DataFrame:
        return self._load("seconds", [self.schema[USER], *SECONDS])

    def touched(self, write_id: str) -> list[int]:
        """The buckets of the users of a write; at most `buckets` numbers."""
        return [r[0] for r in self.moments().where(F.col(WRITE_ID) == write_id).select(BUCKET).distinct().orderBy(BUCKET).collect()]

    def scored(
        self,
        buckets: Sequence[int] | None = None,
        z_threshold: float = detect.Z_THRESHOLD,
        window_s: int = detect.WINDOW_S,
        max_tx: int = detect.MAX_TX,
        share: Share = Share(),
    ) -> DataFrame:
        """The Gold rows of these buckets, or of all, as `gold_alerts` gives them over all rows together."""
        within = F.lit(True) if buckets is None else F.col(BUCKET).isin(*buckets)
        # A user with equal amounts has no deviation; means that differ in the last digit must not make one.
        spread = F.when(F.col("low") == F.col("high"), 0.0).otherwise(F.sqrt(F.col("m2") / (F.col("n") - 1)))
        users = merged_moments(self.moments().where(within), BUCKET, USER).select(
            BUCKET, USER, F.col("mean").alias("user_avg"), F.when(F.col("n") > 1, spread).alias("user_std")
        )
        counts = trailing(self.seconds().where(within), window_s)

        def flags(df: DataFrame, amount: str) -> DataFrame:
            outlier = detect.is_outlier(amount, "user_avg", "user_std", z_threshold)
            return df.withColumns({"zscore_alert": outlier, "frequency_alert": F.col("window_tx") > max_tx})

        keys = [BUCKET, USER]
        both = F.max(F.col("zscore_alert") & F.col("frequency_alert"))
        labels = flags(lookup(counts, users, keys), "top").groupBy(*keys).agg(both.alias("is_fraud"))
        side = lookup(lookup(counts.drop("top"), users, keys), labels, keys)  # all that is known of a user's second
        rows = self.rows().where(within).drop("is_fraud", WRITE_ID).withColumn("_second", F.unix_timestamp(TS))
        found = lookup_by_share(rows, side, [*keys, "_second"], share.in_input())
        return flags(found, AMOUNT).drop("_second").withColumns(
            {
                "is_fraud": F.col(USER).isNotNull() & holds(F.col("is_fraud")),
                "alert": F.col("zscore_alert") | F.col("frequency_alert"),
                "score": mean_of_flags("zscore_alert", "frequency_alert"),
                "risk_level": level_of("zscore_alert", "frequency_alert"),
                "layer": F.lit("gold"),
                "processed_at": F.current_timestamp(),
            }
        )

    def refresh(self, path: str, write_id: str, **thresholds: float) -> list[int]:
        """Score the users of a write again, and put them in the place of what is stored of their buckets; these."""
        buckets = self.touched(write_id)
        if buckets:
            rows = self.scored(buckets, **thresholds)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("layer", BUCKET).parquet(path)
        return buckets

    def _replace(self, name: str, df: DataFrame) -> None:
        dealt = df.repartition(BUCKET, WRITE_ID) if name != "rows" else df
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET, WRITE_ID).parquet(f"{self.root}/{name}")

    def _load(self, name: str, fields: Sequence[T.StructField]) -> DataFrame:
        stored = T.StructType([*[T.StructField(f.name, f.dataType) for f in fields], *LAYOUT])
        read = self.spark.read.schema(stored).parquet
        return read_if_present(self.spark, read, f"{self.root}/{name}", stored).select(stored.names)
