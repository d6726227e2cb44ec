"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only.

A window of an item occurs in a document only where all of the window's shingles do. So each window is
looked up by one of them, the one that is rarest over all documents, and the found places are verified
word by word. Windows that have a shingle no document has are dropped.

Documents are read once: a bitmap of all item shingles, whose size is bounded, tells for each place of a
text whether its shingle may be one of an item. Those places, with the words around them, are all that
is counted, joined and verified.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverlane.llm.store import pick, stored

#: What stands between words, after A-Z became a-z.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a shingle, at most; shorter windows are looked up by a shingle of their own length.
SHINGLE = 3
#: Bits of the bitmap for each shingle of an item, and its least and largest size as powers of two.
BITS_EACH = 128
LEAST_BITS, MOST_BITS = 16, 24


def words(text: str | Column) -> Column:
    """The words of a text; none for null."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(lowered, BREAKS), ""), F.array().cast("array<string>"))


def shingle_hash(words: Column, at: Column, size: int) -> Column:
    """Hash of `size` words from place `at` on; sizes never meet."""
    return F.xxhash64(F.lit(size), *[F.get(words, at + k) for k in range(size)])


def places(n: Column) -> Column:
    """0 .. n-1, empty for n below one."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def windows(items: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(window, words, n) for each distinct window, and (window, item_id) for the items it is in."""
    spelled = items.select("item_id", words("text").alias("words"))
    n = F.size("words")
    starts = places(F.when(n > 0, F.greatest(n - size + 1, F.lit(1))).otherwise(0))
    each = spelled.select("item_id", F.explode(F.transform(starts, lambda k: F.slice("words", k + 1, size))).alias("words"))
    each = stored(each.distinct(), "item-windows")
    once = each.select("words").distinct().withColumn("window", F.monotonically_increasing_id())
    once = stored(once.withColumn("n", F.size("words")), "windows")
    return once, once.join(each, "words").select("window", "item_id")


def window_shingles(once: DataFrame, sizes: list[int]) -> DataFrame:
    """(window, hash, at) for each shingle of each window."""
    parts = []
    for size in sizes:
        whole = F.col("n") >= SHINGLE if size == SHINGLE else F.col("n") == size
        starts = places(F.col("n") - size + 1)
        listed = F.transform(starts, lambda k: F.struct(shingle_hash(F.col("words"), k, size).alias("hash"), k.alias("at")))
        parts.append(once.where(whole).select("window", F.inline(listed)))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def bitmap(hashes: DataFrame, bits: int) -> Column:
    """A constant array of 2**bits bits, in longs, with the bit of each hash set."""
    at = F.shiftrightunsigned("hash", 64 - bits)
    set_ = (
        hashes.select(F.shiftright(at, 6).cast("int").alias("k"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("k")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("long"))
        .collect()  # at most 2**bits / 64 rows
    )
    longs = [0] * (1 << bits - 6)
    for row in set_:
        longs[row["k"]] = row["long"]
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")


def may_have(bitmap: Column, hashed: Column, bits: int) -> Column:
    at = F.shiftrightunsigned(hashed, 64 - bits)
    long = F.get(bitmap, F.shiftright(at, 6).cast("int"))
    shifted = F.call_function("shiftrightunsigned", long, at.bitwiseAND(F.lit(63)).cast("int"))
    return shifted.bitwiseAND(F.lit(1).cast("long")) == 1


def surroundings(hashes: Column, reach: int, window: int) -> Callable[[Column], Column]:
    """What is kept of a place: its hash, and the words from `reach` before it to the end of a window from it on."""

    def at(place: Column) -> Column:
        origin = F.greatest(place - reach, F.lit(0))
        return F.struct(
            place.alias("place"),
            F.get(hashes, place).alias("hash"),
            origin.alias("origin"),
            F.slice("words", origin + 1, place + window - origin).alias("around"),
        )

    return at


def suspects(docs: DataFrame, shingles: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """(row, doc_id, n_words, found): of each text the places whose shingle an item may have.

    `found` has the place, the hash, and the words around it, from place `origin` on, that a window
    with this shingle can reach.
    """
    n = shingles.select("hash").distinct().count()
    bits = min(max((n * BITS_EACH).bit_length(), LEAST_BITS), MOST_BITS)
    known = bitmap(shingles.select("hash"), bits)
    spelled = docs.select("doc_id", words("text").alias("words"))
    for size in sizes:
        hashes = F.transform(places(F.size("words") - size + 1), lambda k: shingle_hash(F.col("words"), k, size))
        spelled = spelled.withColumn(f"hash{size}", hashes)
    found = []
    for size in sizes:
        hashes = F.col(f"hash{size}")
        marked = F.transform(hashes, lambda x, k: F.when(may_have(known, x, bits), k).otherwise(-1))
        found.append(F.transform(F.array_remove(marked, -1), surroundings(hashes, window - size, window)))
    return spelled.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.concat(*found).alias("found"),
    )


def occurrences(docs: DataFrame, items: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored texts, (row, start, n, window) of all windows that occur in them, and the windows' items."""
    once, members = windows(items, window)
    sizes = [r[0] for r in once.select(F.least("n", F.lit(SHINGLE))).distinct().collect()] or [SHINGLE]
    shingles = window_shingles(once, sizes)
    texts = stored(suspects(docs, shingles, sizes, window), "suspects")
    found = texts.where(F.size("found") > 0).select("row", "n_words", F.inline("found"))
    often = found.groupBy("hash").agg(F.count(F.lit(1)).alias("often"))
    rarity = F.struct("often", "hash", "at")
    # A window all of whose shingles occur; its prefix is the rarest of them.
    prefix = (
        shingles.join(often, "hash", "left")
        .groupBy("window")
        .agg(F.min(rarity).alias("rare"), F.count("often").alias("seen"), F.count(F.lit(1)).alias("all"))
        .where("seen = all")
        .select("window", "rare.hash", "rare.at")
    )
    prefix = stored(prefix.join(once, "window"), "prefixes")
    start = F.col("place") - F.col("at")
    inside = F.slice("around", F.greatest(start - F.col("origin"), F.lit(0)) + 1, F.col("n"))
    hits = (
        found.join(prefix, "hash")
        .where((start >= 0) & (start + F.col("n") <= F.col("n_words")) & (inside == F.col("words")))
        .select("row", start.alias("start"), "n", "window")
    )
    return texts, stored(hits, "hits"), members


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids) for each row of `docs`.

    n_hit counts the words inside any occurrence of a window of an item; item_ids are the items with
    occurring windows, sorted as strings. An item with fewer words than a window is one window; without
    words it has none. Null and empty texts have no words. Repeated rows and null ids stay; an item
    without an id marks words, but is not listed. Other columns are not looked at.
    """
    texts, hits, members = occurrences(
        pick(docs, doc_id=doc_id, text=text), pick(items, item_id=item_id, text=item_text), window
    )
    end = F.col("start") + F.col("n")
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        hits.groupBy("row", "start")
        .agg(F.max("n").alias("n"))
        .withColumn("from", F.greatest("start", F.coalesce(F.max(end).over(before), F.col("start"))))
        .groupBy("row")
        .agg(F.sum(F.greatest(end - F.col("from"), F.lit(0))).cast("long").alias("n_hit"))
    )
    named = (
        hits.select("row", "window")
        .distinct()
        .join(members, "window")
        .where("item_id IS NOT NULL")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    none = F.array().cast("array<string>")
    return (
        texts.select("row", "doc_id", "n_words")
        .join(covered.join(named, "row", "left"), "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("item_ids", none).alias("item_ids"),
        )
    )


def clean_only(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text") -> DataFrame:
    """The rows of `docs` without any occurrence of a window of an item, as they are; null and empty texts stay."""
    key = f"_{docs.columns.index(text)}"
    numbered = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    texts = numbered.select(F.md5(key).alias("digest"), F.col(key).alias("text"))
    hit = decontaminate(texts, items, window, doc_id="digest").where("n_hit > 0").select("doc_id").distinct()
    return numbered.join(hit, F.md5(key) == F.col("doc_id"), "left_anti").toDF(*docs.columns)


def digests(found: DataFrame) -> DataFrame:
    """The report with the items as a digest, and whether a document is contaminated."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: The same report in SQL, straight from the definition.
SQL = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w : w <> '') AS words
  FROM documents),
item_words AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w : w <> '') AS words
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, list_slice(words, s, s + 9) AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s
        FROM item_words WHERE len(words) > 0)),
lens AS (SELECT DISTINCT len(win) AS m FROM item_windows),
doc_windows AS (
  SELECT doc_id, m, s, list_slice(words, s, s + m - 1) AS win
  FROM (SELECT doc_id, words, m, unnest(range(1, len(words) - m + 2)) AS s
        FROM doc_words, lens WHERE len(words) >= m)),
hits AS (SELECT d.doc_id, d.s, d.m, i.item_id FROM doc_windows d JOIN item_windows i ON d.win = i.win),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM (SELECT DISTINCT doc_id, s, m FROM hits)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words w LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
