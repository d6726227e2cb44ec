"""Decontamination, url rules and revisits against plain Python."""

from __future__ import annotations

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from silverlane.llm import decontaminate, urls, warc


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def slow_report(docs, items, window):
    out = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item_id, item in items:
            parts = words_of(item)
            for s in range(max(len(parts) - window, 0) + 1 if parts else 0):
                win = parts[s : s + window]
                for at in range(len(words) - len(win) + 1):
                    if words[at : at + len(win)] == win:
                        hit.update(range(at, at + len(win)))
                        found |= {str(item_id)} - {"None"}
        out.append((str(doc_id), len(words), len(hit), len(found), ",".join(sorted(found))))
    return sorted(out)


@pytest.mark.parametrize("window", [10, 4])
def test_decontamination(spark, documents, odd_texts, window):
    rng = random.Random(4)
    vocabulary = ["the", "of", "a", "É", "x1", "deep", "lake", "中", "wood", "Run"]

    def line(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))

    items = [(k, line(n)) for k, n in enumerate([1, 2, 3, 4, 9, 10, 11, 25, 40])]
    items += [(20, items[7][1]), (20, items[8][1]), (21, None), (22, "..."), (None, line(12)), (10, "the " * 30)]
    docs = [(k, t) for k, t in enumerate(odd_texts)]
    for k in range(40):
        parts = [line(rng.randint(0, 30))]
        if k % 2:
            words = words_of(rng.choice(items[4:9])[1])
            a = rng.randint(0, len(words) - 1)
            parts.append(" - ".join(words[a : a + rng.randint(1, 15)]).upper())
        docs.append((100 + k % 35, " ".join([*parts, line(3)])))
    docs += [docs[-1], (None, items[8][1])]
    table = documents(docs).withColumn("hash", F.lit(1)).withColumn("words", F.lit("x"))
    items_table = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(0))
    got = decontaminate.decontaminate(table, items_table, window).collect()
    assert sorted((str(r[0]), *r[1:4], ",".join(r.item_ids)) for r in got) == slow_report(docs, items, window)

    clean = decontaminate.clean_only(table, items_table, window)
    assert clean.columns == table.columns
    # Rows go by their own text, also where ids repeat.
    alone = [(k, t) for (k, t) in docs if slow_report([(0, t)], items, window)[0][2] == 0]
    assert sorted((str(r.doc_id), str(r.text)) for r in clean.collect()) == sorted((str(k), str(t)) for k, t in alone)


def test_decontamination_of_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.digests(decontaminate.decontaminate(documents([(1, "a b"), (2, None)]), none)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows) == [(1, 2, 0, 0, False), (2, 0, 0, 0, False)]
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.decontaminate(documents([]), some).collect() == []


ALLOW, BLOCK, HOSTS = ("org/", "com/fr/", "co.uk"), ("example.org/es/", "example.org/en/1", "com/de/", "com/fr/x"), ("bad.com", "net")


def slow_judge(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for key in (*ALLOW, *BLOCK):
        name = key.partition("/")[0]
        if (host == name or host.endswith("." + name)) and path.startswith(key[len(name) :]):
            fits.append((len(key), key in BLOCK, key))
    if fits:
        rule = max(fits)[2]
        return host, path, rule, "block" if rule in BLOCK else "allow"
    bad = any(host == h or host.endswith("." + h) for h in HOSTS)
    return host, path, None, "block" if bad else "allow"


def test_url_rules(spark):
    rng = random.Random(8)
    hosts = ["example.org", "EXAMPLE.org", "a.b.example.org", "xexample.org", "x.com", "bad.com", "www.bad.com", "notbad.com", "org", "", "q.net", "a.co.uk", "ÉÀ.org", "a..org", "h.org:80"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/17/x", "/en/2", "/de/x", "/fr/", "/fr/x/", "/FR/", "/é/\n/x"]
    found = [None, "", "no url", "://", "http:/x", "http://a://b/c"]
    found += [f"{rng.choice(['http', 'ftp', ''])}://{h}{p}{rng.choice(['', '?q=/es/', '#a', '?'])}" for h in hosts for p in paths]
    rows = [(k % 150, u) for k, u in enumerate(found + found[:10])] + [(None, "http://org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("keys", F.lit(1))
    got = sorted((str(r[0]), *map(str, r[1:])) for r in urls.judge(pages, ALLOW, BLOCK, HOSTS).collect())
    assert got == sorted((str(k), *map(str, slow_judge(u))) for k, u in rows)
    assert urls.judge(pages.limit(0), ALLOW, BLOCK, HOSTS).collect() == []


def test_rules_of_one_length_and_shapes_that_occur(spark):
    allow, block = ("b.org/xy", "q.net", "b.org/x/z", "same.io/"), ("a.b.org/", "p.q.net/long/path/", "same.io/", "z.b.org/")
    found = ["http://a.b.org/xyz", "http://z.b.org/x/z", "http://a.b.org/q", "http://b.org/xy", "http://p.q.net/long", "http://p.q.net/long/path/1", "http://same.io/"]
    pages = spark.createDataFrame(list(enumerate(found)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages, allow, block, []).collect()}
    assert got == {
        0: ("a.b.org/", "block"),  # b.org/xy is as long and allows
        1: ("b.org/x/z", "allow"),
        2: ("a.b.org/", "block"),
        3: ("b.org/xy", "allow"),
        4: ("q.net", "allow"),
        5: ("p.q.net/long/path/", "block"),
        6: ("same.io/", "block"),
    }
    sql = urls.sql(allow, block, ["none.such"])
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(found)))
    assert {r[0]: (r[3], r[4]) for r in con.execute(sql).fetchall()} == got
    assert urls.Rules.of(allow).shapes != [] and len({*urls.Rules.of(allow).shapes, *urls.Rules.of(block).shapes}) == 6
    bare = urls.judge(pages, [], [], []).collect()
    assert {(r.rule, r.verdict) for r in bare} == {(None, "allow")}


def test_blocked_hosts_from_a_table(spark):
    hosts = [*HOSTS, *HOSTS, None, *[f"h{k}.some.io" for k in range(3000)]]
    listed = spark.createDataFrame([(0, h) for h in hosts], "n int, key string")
    urls_ = ["http://www.bad.com/x", "http://bad.com", "http://notbad.com", "http://a.h7.some.io/", "http://h3000.some.io", "http://some.io", None, ""]
    urls_ += [f"http://{h}/" for h in HOSTS]
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, ALLOW, BLOCK, listed).collect()}
    same = {r.page_id: r.verdict for r in urls.judge(pages, ALLOW, BLOCK, [h for h in hosts if h]).collect()}
    assert got == same and got[3] == "block" and got[4] == "allow"
    wanted = {k: slow_judge(u)[3] for k, u in enumerate(urls_)} | {3: "block"}
    assert got == wanted
    allow, block = (spark.createDataFrame([(k, 1) for k in (*keys, None, keys[0])], "key string, n int") for keys in (ALLOW, BLOCK))
    tables = urls.judge(pages, allow, block, listed).collect()
    assert sorted(tables) == sorted(urls.judge(pages, ALLOW, BLOCK, listed).collect())
    assert {r.page_id: r.verdict for r in tables} == wanted
    nothing = urls.judge(pages, ALLOW, BLOCK, listed.limit(0)).collect()
    assert {r.page_id for r in nothing if r.verdict == "block"} == {k for k, u in enumerate(urls_) if slow_judge(u)[2] in BLOCK}


def test_cascade_is_exact_with_tiny_filters(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS_EACH", 2)
    monkeypatch.setattr(urls, "LEAST_BITS", 7)
    universe = spark.range(6000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 6 == 0).alias("listed")).cache()
    cascade = urls.build(universe)
    assert len(cascade.levels) > 3
    assert universe.where(cascade.has(F.col("key")) != F.col("listed")).count() == 0
    nothing = urls.build(universe.withColumn("listed", F.lit(False)))
    assert universe.where(nothing.has(F.col("key"))).count() == 0


@pytest.mark.parametrize(
    "url, key",
    [
        ("HTTP://WWW.Example.org:80/a/?utm_source=x&b=2&a=1#top", "example.org/a?a=1&b=2"),
        ("https://example.org/a?ref=1", "example.org/a"),
        ("https://example.org", "example.org"),
        ("https://example.org:8080/?reference=1", "example.org:8080?reference=1"),
        ("no url", None),
        (None, None),
    ],
)
def test_canonical_url(spark, url, key):
    one = spark.createDataFrame([(url,)], "url string")
    assert one.select(warc.canonical_url("url")).first()[0] == key


RECORD = "record_id string, url string, ts long, kind string, headers map<string,string>"


def test_revisits(spark):
    def full(name, ts, etag, url="http://a.org/x", **more):
        return (name, url, ts, "response", {"ETag": etag, "Content-Length": "9", "X": "1", **more})

    def again(name, ts, headers, url="http://a.org/x#f"):
        return (name, url, ts, "revisit", headers)

    rows = [
        full("r1", 10, '"1"'),
        full("r2", 20, '"2"'),
        full("r2b", 20, '"2b"'),
        again("early", 10, {"ETag": '"1"'}),
        again("first", 11, {"etag": 'W/"1"', "content-length": "0", "x": "2", "Y": "3"}),
        again("tie", 25, {"ETag": '"2b"'}),
        again("other", 25, {"ETag": '"2"'}),
        again("silent", 25, None),
        again("nowhere", 25, {"ETag": '"1"'}, url=None),
        again("timeless", None, {"ETag": '"1"'}),
        full("undated", None, '"9"'),
        ("page", "http://a.org/x", 24, "request", None),
        ("plain", "http://b.org/", 1, "response", {"Last-Modified": "d1"}),
        again("dated", 2, {"last-modified": "d1", "Connection": "close"}, "http://b.org"),
        again("redated", 3, {"last-modified": "d2"}, "http://b.org"),
        ("bare", "http://c.org/", 1, "response", None),
        again("unverified", 2, {}, "http://c.org"),
    ]
    records = spark.createDataFrame(rows + [rows[4]], RECORD).withColumn("part", F.lit("clash")).withColumn("full", F.lit(1))
    resolved = warc.resolve_revisits(records).collect()
    got = {r.record_id: (r.outcome, r.response_id, {h.key: h.value for h in r.headers}) for r in resolved}
    assert len(resolved) == 11 and len(got) == 10
    assert got["early"][:2] == got["nowhere"][:2] == got["timeless"][:2] == ("no_response", None)
    assert got["first"] == ("resolved", "r1", {"etag": 'W/"1"', "content-length": "9", "x": "2", "y": "3"})
    assert got["tie"][:2] == ("resolved", "r2b")
    assert got["other"][:2] == got["silent"][:2] == ("other_version", "r2b")
    assert got["dated"] == ("resolved", "plain", {"last-modified": "d1"})
    assert got["redated"][0] == "other_version"
    assert got["unverified"] == ("resolved", "bare", {})
    assert warc.resolve_revisits(records.limit(0)).collect() == []


def test_records_without_url_or_time_are_dealt_out(spark):
    keyed = spark.range(8_000).select(
        F.concat(F.lit("n"), F.col("id")).alias("record_id"),
        F.when(F.col("id") % 2 == 0, F.lit("http://hot.org/")).alias("url_key"),
        F.lit(None).cast("long").alias("ts"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in warc.by_url_and_time(keyed).groupBy("part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 8_000 and max(sizes) < 2_000


def test_a_url_over_many_ranges(spark):
    """One url holds most records, spread over several partitions; its revisits find responses of earlier ones."""
    records = spark.range(0, 4000, 1, 8).select(
        F.concat(F.lit("n"), F.col("id")).alias("record_id"),
        F.when(F.col("id") % 9 == 0, F.concat(F.lit("http://o.org/"), F.col("id") % 5)).otherwise("http://hot.org/").alias("url"),
        F.col("id").alias("ts"),
        F.when(F.col("id").isin(1, 2, 1500, 3003, 9), "response").otherwise("revisit").alias("kind"),
        F.create_map(F.lit("ETag"), F.lit("e")).alias("headers"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = {r.record_id: r.response_id for r in warc.resolve_revisits(records).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    for k in range(4000):
        if k in (1, 2, 1500, 3003, 9):
            continue
        if k % 9 == 0:
            wanted = "n9" if k > 9 and k % 5 == 4 else None
        else:
            wanted = next((f"n{x}" for x in (3003, 1500, 2, 1) if x < k), None)
        assert got[f"n{k}"] == wanted, k
