"""WARC: resolution of not-modified revisits.

A revisit record (a 304 answer) has no payload; it stands for the latest earlier full response of the
same canonical URL, if its validators agree. The as-of join runs at two levels so that one URL with a
third of all captures does not meet in one task: per (URL, period) the last full response is one row;
a window over those rows carries it into later periods; inside a period a window over time finds
nearer ones. Records are numbered and written once; the response's own data are joined by its number,
where AQE splits a hot one, so ids may repeat or be null.

Validators: entity tags compare weakly (a ``W/`` prefix does not count) and decide if both records have
one; else Last-Modified decides if both have it; else the payload digest. Headers: the revisit's
fields replace the response's, names in lower case, except fields that describe the payload or the
connection, which stay the response's.

Status: resolved, validator_mismatch, no_validator, no_earlier_response. Defined results: records
without URL or time are never matched (no_earlier_response for revisits); "earlier" is strict; of full
responses at the same time the one with the largest id counts (a null id is the smallest; of equal ids
the larger digest of the validators, equal ones are alike); null headers count as none; of header
names that differ in case only the last counts; every revisit record returns once, whatever ids repeat
or are null; a response without id resolves with a null ``source_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterspark.session import ensure_checkpoint_dir

PERIOD_S = 86_400
# fixed values: fields that a not-modified answer may not replace (payload description, hop by hop)
KEPT_FIELDS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
               "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection",
               "te", "trailer", "transfer-encoding", "upgrade")
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www., user and default port, then path and sorted query: no scheme,
    fragment, tracking parameters or trailing slash."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    args = F.split(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1), "&")
    args = F.sort_array(F.filter(args, lambda a: (a != "") & ~F.lower(a).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(args) > 0, F.concat(F.lit("?"), F.array_join(args, "&"))).otherwise(""))


def _fields(headers: Column) -> Column:
    """Header entries with lower-case names; of equal names the last stays."""
    low = F.transform(F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>")),
                      lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(low, lambda e: e["key"])
    return F.filter(low, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), e["key"]))


def merged_headers(response: Column, revisit: Column) -> Column:
    """Sorted (key, value) entries of the response updated by the permitted fields of the revisit."""
    fresh = F.filter(_fields(revisit), lambda e: ~e["key"].isin(*KEPT_FIELDS))
    names = F.transform(fresh, lambda e: e["key"])
    old = F.filter(_fields(response), lambda e: ~F.array_contains(names, e["key"]))
    return F.sort_array(F.concat(old, fresh))


def _tag(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s*W/", "")


def resolve(records: DataFrame, period_s: int = PERIOD_S) -> DataFrame:
    """One row per revisit of ``records`` (record_id long, url string, ts long seconds, kind string
    'response' or 'revisit', status int, etag, last_modified, digest string, headers map): record_id,
    canonical_url, source_id, outcome, payload_digest, headers (array of key and value)."""
    ensure_checkpoint_dir(records.sparkSession)
    r = records.select("record_id", canonical_url(F.col("url")).alias("key"), F.col("ts").cast("long").alias("ts"),
                       (F.col("kind") == "revisit").alias("revisit"),
                       ((F.col("kind") == "response") & (F.col("status") == 200)).alias("full"),
                       "etag", "last_modified", "digest", "headers", F.xxhash64("etag", "last_modified", "digest").alias("tie"))
    r = r.where(F.col("full") | F.col("revisit")).withColumn("row", F.monotonically_increasing_id()).checkpoint(eager=True)
    timed = F.col("key").isNotNull() & F.col("ts").isNotNull()
    slim = r.where(timed).select("row", "record_id", "tie", "key", "ts", "full", F.floor(F.col("ts") / period_s).alias("period"))
    capture = F.struct("ts", "record_id", "tie", "row")
    last = slim.where("full").groupBy("key", "period").agg(F.max(capture).alias("last"))
    periods = slim.select("key", "period").distinct().join(last, ["key", "period"], "left")
    before = Window.partitionBy("key").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    carried = periods.select("key", "period", F.max("last").over(before).alias("carried"))
    earlier = Window.partitionBy("key", "period").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    near = slim.withColumn("near", F.max(F.when(F.col("full"), capture)).over(earlier)).where("not full")
    found = near.join(carried, ["key", "period"], "left").select("row", F.coalesce("near", "carried")["row"].alias("source_row"))
    source = r.where("full").select(F.col("row").alias("source_row"), F.col("record_id").alias("source_id"), F.col("etag").alias("s_etag"), F.col("last_modified").alias("s_modified"),
                                    F.col("digest").alias("s_digest"), F.col("headers").alias("s_headers"))
    x = r.where("revisit").join(found, "row", "left").join(source, "source_row", "left")
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    agree = (F.when(both("etag", "s_etag"), _tag(F.col("etag")) == _tag(F.col("s_etag")))
             .when(both("last_modified", "s_modified"), F.col("last_modified") == F.col("s_modified"))
             .when(both("digest", "s_digest"), F.col("digest") == F.col("s_digest")))
    outcome = (F.when(F.col("source_row").isNull(), "no_earlier_response").when(agree.isNull(), "no_validator")
               .when(agree, "resolved").otherwise("validator_mismatch"))
    x = x.withColumn("outcome", outcome)
    ok = F.col("outcome") == "resolved"
    return x.select("record_id", F.col("key").alias("canonical_url"), "source_id", "outcome",
                    F.when(ok, F.col("s_digest")).alias("payload_digest"),
                    F.when(ok, merged_headers(F.col("s_headers"), F.col("headers"))).alias("headers"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Capture records derived from ``pages``: a full response per page and, for every page, a revisit
    some hours to days away whose URL, validators and headers vary with the page id."""
    p = pages.select("page_id", "url", F.md5(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"))
    n = F.pmod("page_id", F.lit(11))
    ts = F.lit(1_600_000_000) + F.col("page_id") * 60
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), F.floor(ts / 86_400).cast("string"))
    response = p.select(
        (F.col("page_id") * 2).alias("record_id"), "url", ts.alias("ts"), F.lit("response").alias("kind"),
        F.when(n == 10, 503).otherwise(200).alias("status"), F.when(n != 7, tag).alias("etag"), F.when(n != 8, modified).alias("last_modified"), "digest",
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.lit("1000"), F.lit("Cache-Control"), F.lit("max-age=60"),
                     F.lit("Server"), F.lit("a")).alias("headers"))
    variant = F.when(n % 3 == 0, F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again"))).otherwise(F.regexp_replace("url", "^https:", "http:"))
    revisit = p.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), variant.alias("url"), (ts + F.when(n == 5, -7_200).otherwise(n * 40_000)).alias("ts"),
        F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.when(n == 2, F.concat(F.lit("W/"), tag)).when(n == 3, F.lit('"other"')).when(n.isin(4, 8), F.lit(None)).otherwise(tag).alias("etag"),
        F.when(n.isin(7, 4), modified).alias("last_modified"), F.lit(None).cast("string").alias("digest"),
        F.create_map(F.lit("cache-control"), F.lit("max-age=90"), F.lit("content-length"), F.lit("0"), F.lit("Date"), F.concat(F.lit("t"), ts.cast("string"))).alias("headers"))
    return response.unionByName(revisit)


ORACLE = r"""
WITH p AS (SELECT page_id, url, md5(coalesce(html, '')) AS digest, page_id % 11 AS n, 1600000000 + page_id * 60 AS t FROM pages),
c AS (
  SELECT page_id * 2 AS record_id, url, t AS ts, FALSE AS revisit, n <> 10 AS full_, CASE WHEN n <> 7 THEN '"' || substr(digest, 1, 16) || '"' END AS etag,
    CASE WHEN n <> 8 THEN 'day ' || (t // 86400) END AS modified, digest, t AS t0 FROM p
  UNION ALL
  SELECT page_id * 2 + 1, CASE WHEN (n % 3) = 0 THEN regexp_replace(url, '#.*$', '') || '#again' ELSE regexp_replace(url, '^https:', 'http:') END,
    t + CASE WHEN n = 5 THEN -7200 ELSE n * 40000 END, TRUE, FALSE,
    CASE WHEN n = 2 THEN 'W/"' || substr(digest, 1, 16) || '"' WHEN n = 3 THEN '"other"' WHEN n IN (4, 8) THEN NULL ELSE '"' || substr(digest, 1, 16) || '"' END,
    CASE WHEN n IN (7, 4) THEN 'day ' || (t // 86400) END, NULL, t FROM p),
u AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*://', '') AS rest FROM c),
k AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'), lambda a: a <> '' AND NOT regexp_matches(lower(a), '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) AS args
  FROM u),
r AS (SELECT *, place || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS key FROM k),
s AS (SELECT key, ts, max(record_id) AS source_id FROM r WHERE full_ GROUP BY key, ts),
j AS (SELECT a.*, s.source_id FROM (SELECT * FROM r WHERE revisit) a ASOF LEFT JOIN s ON a.key = s.key AND a.ts > s.ts),
m AS (
  SELECT j.record_id, j.key AS canonical_url, j.source_id, f.digest AS s_digest, j.t0,
    CASE WHEN j.etag IS NOT NULL AND f.etag IS NOT NULL THEN regexp_replace(j.etag, '^\s*W/', '') = regexp_replace(f.etag, '^\s*W/', '')
         WHEN j.modified IS NOT NULL AND f.modified IS NOT NULL THEN j.modified = f.modified END AS agree
  FROM j LEFT JOIN r f ON f.full_ AND f.record_id = j.source_id)
SELECT record_id, canonical_url, source_id,
  CASE WHEN source_id IS NULL THEN 'no_earlier_response' WHEN agree IS NULL THEN 'no_validator' WHEN agree THEN 'resolved' ELSE 'validator_mismatch' END AS outcome,
  CASE WHEN source_id IS NOT NULL AND agree THEN s_digest END AS payload_digest,
  CASE WHEN source_id IS NOT NULL AND agree THEN 'cache-control: max-age=90' || chr(10) || 'content-length: 1000' || chr(10) || 'content-type: text/html' || chr(10) || 'date: t' || t0 || chr(10) || 'server: a' END AS headers
FROM m
"""
