"""Not-modified revisits: an as-of join by canonical url to the latest earlier full response.

A server that answers "not modified" sends headers but no body. Its record is resolved to the latest
earlier full response of the same canonical url, if the validators of the two agree, and the headers
that such an answer may change are merged into the stored ones.

Records are dealt out by ranges of (url, time), so a url with very many records is spread over many
tasks. Within a task a window finds the latest earlier response. What lies before the task's range is
needed only for urls that begin or end a range, at most two for each task: their last responses are
summed up over the ranges and broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverlane.llm.store import pick, stored

#: Headers a "not modified" answer does not change: they describe a body or one connection.
#: Fixed by RFC 9111 (sections 3.1 and 3.2).
KEPT_HEADERS = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authentication-info",
    "proxy-authorization",
    "proxy-connection",
    "te",
    "transfer-encoding",
    "upgrade",
)
#: Query parameters that only say where a visitor came from; one that ends with `*` stands for all that begin so.
TRACKING = ("utm_*", "fbclid", "gclid", "ref")


def canonical_url(url: str | Column, tracking: tuple[str, ...] = TRACKING) -> Column:
    """What counts as the same address; null for null or without `://`.

    Scheme and fragment do not count, nor do `www.`, a default port, A-Z of the host, a slash at the end,
    and tracking parameters; the other parameters are sorted.
    """
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
    host, path, query = (F.regexp_extract(url, pattern, k) for k in (1, 2, 3))
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)?$", "")
    names = "|".join(name.replace("*", "[^=]*") for name in tracking)
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({names})(=|$)"))
    joined = F.array_join(F.array_sort(parts), "&")
    whole = F.concat(host, F.regexp_replace(path, "/+$", ""), F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""))
    return F.when(F.instr(url, "://") > 0, whole)


def header_list(headers: str | Column) -> Column:
    """Headers as a list sorted by name, names in lower case; of a repeated name the first counts."""
    entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    names = F.array_sort(F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"]))))
    value = lambda name: F.get(F.filter(entries, lambda e: F.lower(e["key"]) == name), F.lit(0))["value"]
    return F.transform(names, lambda name: F.struct(name.alias("key"), value(name).alias("value")))


def value_of(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda e: e["key"] == name), F.lit(0))["value"]


def validators_agree(revisit: Column, response: Column) -> Column:
    """By entity tag (weak comparison) if the revisit has one, else by date of change, else if neither has any."""
    tags = [F.regexp_replace(value_of(h, "etag"), "^W/", "") for h in (revisit, response)]
    dates = [value_of(h, "last-modified") for h in (revisit, response)]
    by_date = F.when(dates[0].isNotNull(), dates[0].eqNullSafe(dates[1])).otherwise(tags[1].isNull() & dates[1].isNull())
    return F.when(tags[0].isNotNull(), tags[0].eqNullSafe(tags[1])).otherwise(by_date)


def merged_headers(response: Column, revisit: Column) -> Column:
    """The stored headers, with those of the revisit that it may change, sorted by name."""
    news = F.filter(revisit, lambda e: ~e["key"].isin(*KEPT_HEADERS))
    names = F.transform(news, lambda e: e["key"])
    return F.array_sort(F.concat(F.filter(response, lambda e: ~F.array_contains(names, e["key"])), news))


def by_url_and_time(keyed: DataFrame) -> DataFrame:
    """The records in ranges of (url, time), with the number of the range.

    Records without url or time, which find no response, are dealt by their ids, so that any number of them is no one task's work.
    """
    adrift = F.when(F.col("url_key").isNull() | F.col("ts").isNull(), F.xxhash64("record_id"))
    return keyed.repartitionByRange("url_key", "ts", adrift).withColumn("part", F.spark_partition_id())


def resolve_revisits(
    records: DataFrame,
    record_id: str = "record_id",
    url: str = "url",
    ts: str = "ts",
    kind: str = "kind",
    headers: str = "headers",
    tracking: tuple[str, ...] = TRACKING,
) -> DataFrame:
    """(record_id, url_key, ts, outcome, response_id, headers) for each record whose kind is `revisit`.

    `ts` is a long; records of kind `response` are full responses, others are ignored. A response is
    earlier if its ts is smaller; of several at the same ts that of the largest id counts. The outcome is
    `resolved`, `other_version` if the validators disagree (response_id then tells of what), or `no_response`
    if there is no earlier one, which is also the outcome without url or ts. Headers are merged where
    resolved, else the revisit's own, as an array of (key, value). Repeated rows stay; other columns
    are not looked at.
    """
    rows = pick(records, record_id=record_id, url=url, ts=ts, kind=kind, headers=headers)
    keyed = rows.where(F.col("kind").isin("response", "revisit")).select(
        "record_id",
        canonical_url("url", tracking).alias("url_key"),
        F.col("ts").cast("long").alias("ts"),
        (F.col("kind") == "response").alias("full"),
        header_list("headers").alias("headers"),
    )
    dealt = stored(by_url_and_time(keyed), "captures")
    response = F.when(F.col("full") & F.col("ts").isNotNull(), F.struct("ts", "record_id", "headers"))

    ends = dealt.groupBy("part").agg(F.min("url_key").alias("low"), F.max("url_key").alias("high"))
    split_urls = ends.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("url_key")).distinct()
    by_part = (
        dealt.join(F.broadcast(split_urls), "url_key")  # at most two urls for each part
        .groupBy("url_key", "part")
        .agg(F.max(response).alias("last"))
    )
    parts_before = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_part.select("url_key", "part", F.max("last").over(parts_before).alias("carried")).where("carried IS NOT NULL")

    earlier = Window.partitionBy("url_key", "part").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("within", F.max(response).over(earlier)).where("NOT full")
    found = within.join(F.broadcast(carried), ["url_key", "part"], "left").withColumn(
        "response", F.when(F.col("url_key").isNotNull() & F.col("ts").isNotNull(), F.coalesce("within", "carried"))
    )
    agree = validators_agree(F.col("headers"), F.col("response.headers"))
    outcome = F.when(F.col("response").isNull(), "no_response").when(agree, "resolved").otherwise("other_version")
    merged = F.when(F.col("outcome") == "resolved", merged_headers(F.col("response.headers"), F.col("headers")))
    return found.withColumn("outcome", outcome).select(
        "record_id",
        "url_key",
        "ts",
        "outcome",
        F.col("response.record_id").alias("response_id"),
        F.coalesce(merged, F.col("headers")).alias("headers"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures of the given pages, as a crawler that comes back would have stored them.

    Every page is a full response. Two of three are asked for again later, in another spelling of the
    url, and have not changed; one in seven of those answers names another version, and one in eleven
    names none. One page in five was also asked for a minute before its response.
    """
    n = F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    at = n % 86400 * 60

    def headers(**values: Column) -> Column:
        return F.create_map(*[x for name, v in values.items() for x in (F.lit(name.replace("_", "-")), v)])

    full = pages.select(
        F.concat(F.lit("r"), n).alias("record_id"),
        "url",
        at.alias("ts"),
        F.lit("response").alias("kind"),
        headers(ETag=tag, Content_Length=F.octet_length("html").cast("string"), Cache_Control=F.lit("max-age=60")).alias("headers"),
    )
    seen = F.when(n % 7 == 3, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))
    again = headers(etag=seen, content_length=F.lit("0"), cache_control=F.concat(F.lit("max-age="), n % 5), age=F.lit("1"))
    later = pages.where("page_id % 3 > 0").select(
        F.concat(F.lit("v"), n).alias("record_id"),
        F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#seen")).alias("url"),
        (at + 3600 + n % 50).alias("ts"),
        F.lit("revisit").alias("kind"),
        F.when(n % 11 == 4, headers(age=F.lit("1"))).otherwise(again).alias("headers"),
    )
    before = pages.where("page_id % 5 = 0").select(
        F.concat(F.lit("e"), n).alias("record_id"),
        "url",
        (at - 60).alias("ts"),
        F.lit("revisit").alias("kind"),
        headers(etag=tag, age=F.lit("2")).alias("headers"),
    )
    return full.union(later).union(before)


def shown(resolved: DataFrame) -> DataFrame:
    """Headers as lines of text."""
    lines = F.array_join(F.transform("headers", lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return resolved.withColumn("headers", lines)


#: The captures and their resolution in SQL, over `pages`.
SQL = r"""
WITH base AS (
  SELECT page_id, url, '"' || substr(md5(html), 1, 16) || '"' AS tag, octet_length(encode(html)) AS bytes,
    page_id % 86400 * 60 AS taken FROM pages),
records AS (
  SELECT 'r' || page_id AS record_id, url, taken AS ts, true AS is_full, tag AS etag,
    'max-age=60' AS cache, CAST(bytes AS VARCHAR) AS len, NULL AS age FROM base
  UNION ALL
  SELECT 'v' || page_id, regexp_replace(url, '#.*$', '') || '#seen', taken + 3600 + page_id % 50, false,
    CASE WHEN page_id % 11 = 4 THEN NULL WHEN page_id % 7 = 3 THEN '"other"' ELSE 'W/' || tag END,
    CASE WHEN page_id % 11 = 4 THEN NULL ELSE 'max-age=' || page_id % 5 END,
    CASE WHEN page_id % 11 = 4 THEN NULL ELSE '0' END, '1' FROM base WHERE page_id % 3 > 0
  UNION ALL
  SELECT 'e' || page_id, url, taken - 60, false, tag, NULL, NULL, '2' FROM base WHERE page_id % 5 = 0),
split_urls AS (
  SELECT *, regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 1) AS host,
    regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 2) AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 3), '&'),
      lambda p : p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|fbclid|gclid|ref)(=|$)'))) AS params
  FROM records),
keyed AS (
  SELECT record_id, ts, is_full, etag, cache, len, age,
    CASE WHEN instr(url, '://') > 0 THEN
      regexp_replace(regexp_replace(lower(host), '^www\.', ''), ':(80|443)?$', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS url_key
  FROM split_urls),
full_records AS (
  SELECT url_key, ts, max_by(record_id, record_id) AS record_id, max_by(etag, record_id) AS etag,
    max_by(cache, record_id) AS cache, max_by(len, record_id) AS len
  FROM keyed WHERE is_full GROUP BY url_key, ts),
joined AS (
  SELECT k.*, f.record_id AS response_id, f.etag AS etag0, f.cache AS cache0, f.len AS len0
  FROM (SELECT * FROM keyed WHERE NOT is_full) k ASOF LEFT JOIN full_records f ON k.url_key = f.url_key AND k.ts > f.ts),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no_response'
    WHEN regexp_replace(etag, '^W/', '') = regexp_replace(etag0, '^W/', '') THEN 'resolved'
    ELSE 'other_version' END AS outcome FROM joined),
named AS (
  SELECT *, outcome = 'resolved' AS ok, coalesce(cache, CASE WHEN outcome = 'resolved' THEN cache0 END) AS cache1,
    CASE WHEN outcome = 'resolved' THEN len0 ELSE len END AS len1 FROM judged)
SELECT record_id, url_key, ts, outcome, response_id,
  concat_ws(chr(10), 'age: ' || age, 'cache-control: ' || cache1, 'content-length: ' || len1, 'etag: ' || etag) AS headers
FROM named
"""
