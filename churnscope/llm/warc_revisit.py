"""Not-modified revisits of a web archive, resolved to full responses.

``resolve`` joins each revisit record as of its time to the latest earlier full
response with the same canonical URL, checks the validators, and merges the
headers that a 304 answer may update into the response's headers.

The as-of join is a forward fill over records in (URL, time) order. Records are
range partitioned on URL, time and record id, so a URL with a third of all
records spreads over many partitions; each partition is filled as a stream of
sorted batches and written once. What a partition's start needs from earlier
ones is the last response of its first URL: one row per partition, bounded by
the number of partitions, chained on the driver and joined back by partition.

Defined results: a response at the very time of a revisit is not earlier; of
several responses at one time the one with the greatest record id counts, a null
id being the least; a response without id is one, refers_to is then null; a
null or empty URL resolves to nothing (``no_url``); a revisit without validators
is ``unvalidated`` and still names its response; null headers are empty.
Repeated records are resolved each. An empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnscope.llm.common import modest_batches, written

#: What a 304 answer may update (RFC 9110, 15.4.5, and Last-Modified).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Query parameters that only track.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


def canonical(url: Column) -> Column:
    """Host in lower case without www. and default port, path without trailing
    slashes, sorted query without tracking parameters; no scheme, no fragment.
    Null for a null or empty URL."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    kept = F.array_sort(F.filter(F.split(F.regexp_extract(bare, "\\?(.*)$", 1), "&"),
                                 lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(F.trim(url) != "", F.concat(host, path, query))


def fill_schema() -> str:
    return ("pid int, carry boolean, whole boolean, pending boolean, url_key string, record_id string, at long, "
            "etag string, last_modified string, headers string, "
            "ref_found boolean, ref_id string, ref_etag string, ref_modified string, ref_headers string")


def _fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Forward fill of one sorted partition: each revisit with the last response
    of its URL; ``pending`` where the partition starts within the URL and has no
    response for it yet. A last row (carry) tells what the next partition may
    need: the last URL, its last response, and whether the partition holds only it."""
    first = key = None
    last: tuple = (False, None, None, None, None)
    pid, changed = None, False
    for b in batches:
        if not len(b):
            continue
        keys = b["url_key"].to_numpy()
        if first is None:
            first = key = keys[0]
            pid = int(b["pid"].iloc[0])
        response = b["response"].to_numpy()
        n = len(b)
        fresh = np.concatenate([[keys[0] != key], keys[1:] != keys[:-1]])
        start = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))  # where the URL begins; -1: before the batch
        at = np.maximum.accumulate(np.where(response, np.arange(n), -1))
        here = (at >= 0) & (at >= start)
        old = ~here & (start < 0)  # filled by what came before the batch
        refs = b[["response", "record_id", "etag", "last_modified", "headers"]].to_numpy(dtype=object)
        got = np.full((n, 5), None, dtype=object)
        got[:, 0] = False
        got[here] = refs[at[here]]
        got[old] = np.array([last], dtype=object)
        pending = old & (not last[0]) & (not changed)
        keep = ~response
        out = pd.DataFrame({c: b[c].to_numpy()[keep] for c in ("pid", "url_key", "record_id", "at", "etag", "last_modified", "headers")})
        out["carry"], out["whole"], out["pending"] = False, False, pending[keep]
        for i, c in enumerate(("ref_found", "ref_id", "ref_etag", "ref_modified", "ref_headers")):
            out[c] = got[keep, i]
        changed = changed or bool(fresh.any())
        key, last = keys[-1], tuple(got[-1]) if not response[-1] else tuple(refs[-1])
        yield out[[c.split()[0] for c in fill_schema().split(", ")]]
    if first is not None:
        row = {"pid": pid, "carry": True, "whole": not changed, "pending": False, "url_key": key, "record_id": first, "at": 0,
               "etag": None, "last_modified": None, "headers": None,
               "ref_found": last[0], "ref_id": last[1], "ref_etag": last[2], "ref_modified": last[3], "ref_headers": last[4]}
        yield pd.DataFrame([row])


def as_of(records: DataFrame) -> DataFrame:
    """Revisits (url_key, record_id, at, etag, last_modified, headers as JSON) with
    ref_found, ref_id, ref_etag, ref_modified, ref_headers of the latest earlier response.
    ``records`` also has ``response``; no url_key is null."""
    spark = records.sparkSession
    # at one time a revisit stands before a response, which is then not earlier
    order = ["url_key", "at", "response", "record_id"]
    dealt = records.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id())
    filled = written(dealt.mapInPandas(_fill, fill_schema()), "revisits-filled")
    prior, before = [], None
    for r in sorted(filled.where("carry").select("pid", "url_key", "whole", F.col("record_id").alias("first"), "ref_found",
                                                 "ref_id", "ref_etag", "ref_modified", "ref_headers").collect(), key=lambda r: r.pid):
        own = (r.url_key, r.ref_found, r.ref_id, r.ref_etag, r.ref_modified, r.ref_headers)
        known = before is not None and before[0] == r.first and before[1]
        if known:
            prior.append((r.pid, *before[1:]))
        if not r.ref_found and r.whole and known:
            own = before
        before = own
    held = spark.createDataFrame(prior, "pid int, p_found boolean, p_id string, p_etag string, p_modified string, p_headers string")
    rows = filled.where("not carry").join(F.broadcast(held), "pid", "left")

    def either(ref: str, p: str) -> Column:
        return F.when(F.col("pending"), F.col(p)).otherwise(F.col(ref)).alias(ref)

    return rows.select("url_key", "record_id", "at", "etag", "last_modified", "headers",
                       F.coalesce(either("ref_found", "p_found"), F.lit(False)).alias("ref_found"), either("ref_id", "p_id"),
                       either("ref_etag", "p_etag"), either("ref_modified", "p_modified"), either("ref_headers", "p_headers"))


def strong(tag: Column) -> Column:
    """An entity tag without weakness mark and quotes, for weak comparison."""
    return F.regexp_replace(F.regexp_replace(tag, "^W/", ""), '"', "")


def resolve(captures: DataFrame) -> DataFrame:
    """record_id, url_key, refers_to, status, headers (map) of every revisit of
    ``captures`` (record_id, url, at, response, etag, last_modified, headers)."""
    modest_batches(captures.sparkSession)
    rows = captures.select(F.col("record_id").cast("string").alias("record_id"), canonical(F.col("url")).alias("url_key"),
                           F.col("at").cast("long").alias("at"), F.coalesce("response", F.lit(False)).alias("response"),
                           F.col("etag").cast("string").alias("etag"), F.col("last_modified").cast("string").alias("last_modified"),
                           F.to_json(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("headers"))
    joined = as_of(rows.where("url_key is not null"))
    lost = rows.where("url_key is null and not response").select(
        "url_key", "record_id", "at", "etag", "last_modified", "headers", F.lit(False).alias("ref_found"), *(F.lit(None).cast("string").alias(c) for c in (
            "ref_id", "ref_etag", "ref_modified", "ref_headers")))
    both = joined.unionByName(lost)
    status = (F.when(F.col("url_key").isNull(), "no_url").when(~F.col("ref_found"), "no_earlier")
              .when(F.col("etag").isNotNull(), F.when(strong(F.col("etag")) == strong(F.coalesce("ref_etag", F.lit(""))), "resolved")
                    .otherwise("validator_mismatch"))
              .when(F.col("last_modified").isNotNull(), F.when(F.col("last_modified") == F.coalesce("ref_modified", F.lit("")), "resolved")
                    .otherwise("validator_mismatch"))
              .otherwise("unvalidated"))
    both = both.withColumn("status", status)
    kind = "map<string,string>"
    new = F.map_filter(F.from_json("headers", kind), lambda k, v: k.isin(PERMITTED))
    old = F.map_filter(F.from_json("ref_headers", kind), lambda k, v: ~F.array_contains(F.map_keys(new), k))
    merged = F.when(F.col("status").isin("resolved", "unvalidated"), F.map_concat(old, new))
    return both.select("record_id", "url_key", F.col("ref_id").alias("refers_to"), "status", merged.alias("headers"))


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl's records from the pages table: each page was fetched in full one
    to three times and asked for again twice, with exact, weak, changed, dated
    or no validators; times and validators follow from page_id and html."""
    p = pages.select(F.col("page_id").cast("long").alias("p"), "url", F.md5(F.coalesce("html", F.lit(""))).alias("h"))
    at = F.lit(1704067200) + F.pmod(F.col("p") * 7919, F.lit(2592000))
    full = p.withColumn("v", F.explode(F.sequence(F.lit(0).cast("long"), F.pmod("p", F.lit(3)))))
    when = at + F.col("v") * 400000
    tag = F.substring(F.md5(F.concat("h", F.col("v").cast("string"))), 1, 16)
    full = full.select(
        F.concat(F.lit("f"), F.col("p").cast("string"), F.lit("-"), F.col("v").cast("string")).alias("record_id"), "url", when.alias("at"),
        F.lit(True).alias("response"), tag.alias("etag"), (when - 3600).cast("string").alias("last_modified"),
        F.create_map(F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-type"), F.lit("text/html"), F.lit("date"), when.cast("string"),
                     F.lit("etag"), tag, F.lit("server"), F.concat(F.lit("s"), F.col("v").cast("string"))).alias("headers"))
    again = p.withColumn("v", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))))
    later = at - 500 + F.pmod(F.col("p") * 104729 + F.col("v") * 611953, F.lit(1296000))
    # the version fetched last before, as an honest server would name it
    held = F.least(F.pmod("p", F.lit(3)), F.floor(F.greatest(later - at - 1, F.lit(0)) / 400000))
    tag = F.substring(F.md5(F.concat("h", held.cast("string"))), 1, 16)
    how = F.pmod("p", F.lit(5))
    etag = F.when(how == 0, F.concat(F.lit('W/"'), tag, F.lit('"'))).when(how == 1, F.concat(F.lit("x"), tag)).when(how == 4, tag)
    modified = F.when(how == 2, (at + held * 400000 - 3600).cast("string"))
    again = again.select(
        F.concat(F.lit("n"), F.col("p").cast("string"), F.lit("-"), F.col("v").cast("string")).alias("record_id"),
        F.concat("url", F.lit("#again")).alias("url"), later.alias("at"), F.lit(False).alias("response"), etag.alias("etag"),
        modified.alias("last_modified"),
        F.create_map(F.lit("cache-control"), F.lit("max-age=90"), F.lit("date"), later.cast("string"),
                     F.lit("set-cookie"), F.lit("id=1")).alias("headers"))
    return full.unionByName(again)
