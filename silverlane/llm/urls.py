"""URL rules by exact membership in Bloom filter cascades, with DataFrame functions only.

A cascade knows a list of keys among a complete universe of keys. Its first filter encodes the listed
keys, the second those unlisted keys of the universe that the first wrongly has, the third the listed
ones that the second wrongly has, and so on until nothing is left. For any key of the universe the
first filter without it tells exactly whether it is listed, so no join is needed.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlane.llm.store import pick, stored

#: Bits of a filter for each of its keys, hash functions, and bounds of its size as powers of two.
BITS_EACH = 12
HASHES = 4
LEAST_BITS, MOST_BITS = 8, 24
#: A cascade that has not ended after so many levels is not going to.
MOST_LEVELS = 40


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; both empty for null or without `://`."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


@dataclass(frozen=True)
class Rules:
    """Listed keys like `example.org/en/`: a host, which stands for its subdomains too, and a start of a path."""

    keys: tuple[str, ...] | DataFrame

    @classmethod
    def of(cls, keys: Iterable[str] | DataFrame) -> Rules:
        """From the keys, or a table with them in its column `key`, which is not collected."""
        if not isinstance(keys, DataFrame):
            return cls(tuple(keys))
        return cls(stored(pick(keys, key="key").where("key IS NOT NULL").distinct(), "listed-keys"))

    def table(self, spark: SparkSession) -> DataFrame:
        """(key): each listed key."""
        if isinstance(self.keys, DataFrame):
            return self.keys
        return spark.createDataFrame([(key,) for key in sorted(set(self.keys))], "key string")

    @cached_property
    def shapes(self) -> list[tuple[int, int]]:
        """(labels of the host, length of the path) of the listed keys."""
        if isinstance(self.keys, DataFrame):
            host = F.substring_index("key", "/", 1)
            shapes = self.keys.select(F.size(F.split(host, r"\.")), F.length("key") - F.length(host))
            return [tuple(row) for row in shapes.distinct().collect()]  # as few as there are lengths of names and paths
        hosts = [(key, key.partition("/")[0]) for key in self.keys]
        return [(host.count(".") + 1, len(key) - len(host)) for key, host in hosts]


def candidates(host: Column, path: Column, lists: Iterable[Rules]) -> Column:
    """All keys a listed key that fits could be: ends of the host with starts of the path, of the shapes that are listed, each once."""
    parts = F.split(host, r"\.")
    keys = []
    for n, size in sorted({shape for rules in lists for shape in rules.shapes}):
        end = F.array_join(F.slice(parts, -n, n), ".")
        keys.append(F.when((F.size(parts) >= n) & (F.length(path) >= size), F.concat(end, F.substring(path, 1, size))))
    return F.array_distinct(F.array_compact(F.array(*keys).cast("array<string>")))


def _bits(key: Column, level: int, log_bits: int) -> list[Column]:
    return [F.shiftrightunsigned(F.xxhash64(F.lit(level), F.lit(k), key), 64 - log_bits) for k in range(HASHES)]


def _filter(keys: DataFrame, level: int) -> tuple[int, list[int]]:
    """The filter of these keys: the logarithm of its size, and its bits in longs."""
    log_bits = min(max((keys.count() * BITS_EACH).bit_length(), LEAST_BITS), MOST_BITS)
    at = keys.select(F.explode(F.array(*_bits(F.col("key"), level, log_bits))).alias("at"))
    rows = (
        at.select(F.shiftright("at", 6).alias("k"), F.col("at").bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("k")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("long"))
        .collect()  # at most 2**MOST_BITS / 64 rows
    )
    longs = [0] * (1 << log_bits - 6)
    for row in rows:
        longs[row["k"]] = row["long"]
    return log_bits, longs


@dataclass(frozen=True)
class Cascade:
    """Filters of alternating meaning; right for every key of the universe it was built over."""

    levels: tuple[tuple[int, Column], ...]

    def has(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        listed = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels), 0, -1):
            listed = F.when(_in_filter(self.levels[level - 1], key, level), listed).otherwise(F.lit(level % 2 == 0))
        return listed


def _in_filter(filter_: tuple[int, Column], key: Column, level: int) -> Column:
    log_bits, longs = filter_
    found = F.lit(True)
    for at in _bits(key, level, log_bits):
        long = F.get(longs, F.shiftright(at, 6).cast("int"))
        bit = F.call_function("shiftrightunsigned", long, at.bitwiseAND(F.lit(63)).cast("int"))
        found = found & (bit.bitwiseAND(F.lit(1).cast("long")) == 1)
    return found


def build(universe: DataFrame) -> Cascade:
    """The cascade of (key, listed), which has each key of the universe once."""
    levels: list[tuple[int, Column]] = []
    inside, outside = universe.where("listed").select("key"), universe.where("NOT listed").select("key")
    while not levels or not inside.isEmpty():
        if len(levels) == MOST_LEVELS:
            raise ValueError(f"more listed keys than filters of 2**{MOST_BITS} bits can tell apart")
        log_bits, longs = _filter(inside, len(levels) + 1)
        levels.append((log_bits, F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")))
        wrong = stored(outside.where(_in_filter(levels[-1], F.col("key"), len(levels))), "false-positives")
        inside, outside = wrong, inside
    return Cascade(tuple(levels))


def key_universe(spark: SparkSession, keys: DataFrame, rules: Rules) -> DataFrame:
    """(key, listed): every key of the corpus and of the list once."""
    listed = rules.table(spark).withColumn("listed", F.lit(True))
    rest = keys.select("key", F.lit(False).alias("listed"))
    return rest.union(listed).groupBy("key").agg(F.max("listed").alias("listed"))


def judge(
    pages: DataFrame,
    allow: Iterable[str] | DataFrame,
    block: Iterable[str] | DataFrame,
    blocked_hosts: Iterable[str] | DataFrame,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row.

    Of the rules that fit a url the longest decides; of several of one length one that blocks, and of those the greatest
    by code points; a rule that is listed both ways blocks. Where none
    fits, the verdict is block if the host or a domain above it is in `blocked_hosts`, else allow. A long list
    is better a table with a column `key`, whose null keys are none and whose repeated keys count once.
    A null url, or one without `://`, has an empty host and path, fits no rule and is allowed.
    Repeated rows and null ids stay, and other columns are not looked at.
    """
    lists = {"allow": Rules.of(allow), "block": Rules.of(block), "hosts": Rules.of(blocked_hosts)}
    host, path = host_and_path("url")
    rows = pick(pages, page_id=page_id, url=url).select("page_id", host.alias("host"), path.alias("path"))
    keys = candidates(F.col("host"), F.col("path"), lists.values())
    corpus = stored(rows.select(F.explode(keys).alias("key")).distinct(), "url-keys")
    has = {name: build(stored(key_universe(pages.sparkSession, corpus, rules), "universe")).has for name, rules in lists.items()}
    fitting = F.filter("keys", lambda key: has["allow"](key) | has["block"](key))
    longest = F.array_max(F.transform(fitting, lambda key: F.struct(F.length(key).alias("n"), has["block"](key).alias("blocks"), key.alias("key"))))
    verdict = F.when(F.col("rule").isNull(), F.exists("keys", lambda key: has["hosts"](key))).otherwise(has["block"](F.col("rule")))
    return (
        rows.withColumn("keys", keys)
        .withColumn("rule", longest["key"])
        .select("page_id", "host", "path", "rule", F.when(verdict, "block").otherwise("allow").alias("verdict"))
    )


def sql(allow: Iterable[str], block: Iterable[str], blocked_hosts: Iterable[str]) -> str:
    """The same in SQL over `pages`, with the lists as a table of values."""
    values = [(key, "allow") for key in allow] + [(key, "block") for key in block]
    listed = ", ".join(f"('{key.partition('/')[0]}', '{key[len(key.partition('/')[0]):]}', '{key}', '{v}')" for key, v in values)
    hosts = ", ".join(f"('{h}')" for h in blocked_hosts)
    return rf"""
WITH rules(rule_host, rule_path, rule, verdict) AS (VALUES {listed}),
blocked(name) AS (VALUES {hosts}),
urls AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
fits AS (
  SELECT page_id, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, verdict DESC, rule DESC) AS k
  FROM urls, rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
bad AS (SELECT DISTINCT page_id FROM urls, blocked WHERE host = name OR ends_with(host, '.' || name))
SELECT u.page_id, host, path, rule, coalesce(verdict, CASE WHEN bad.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM urls u LEFT JOIN (SELECT * FROM fits WHERE k = 1) f USING (page_id) LEFT JOIN bad USING (page_id)
"""
