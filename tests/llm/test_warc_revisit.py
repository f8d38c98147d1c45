import random

from pyspark.sql import functions as F

from churnscope.llm import warc_revisit as wr


def records(seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        url = "http://hot.example/a" if rng.random() < 0.6 else "http://x%d.example/" % rng.randrange(20)
        response = rng.random() < 0.08
        rows.append(("r%03d" % i, url, rng.randrange(300), response, rng.choice(["A", "B"]) if response else rng.choice(["A", 'W/"A"', "B", None]),
                     rng.choice(["d1", "d2", None]), {"date": str(i), "server": "s%d" % i}))
    return rows + rows[:3]


SCHEMA = "record_id string, url string, at long, response boolean, etag string, last_modified string, headers map<string,string>"


def brute(rows):
    out = []
    for rid, url, at, response, etag, modified, headers in rows:
        if response:
            continue
        earlier = [r for r in rows if r[3] and r[1] == url and r[2] < at]
        if not earlier:
            out.append((rid, None, "no_earlier", None))
            continue
        ref = max(earlier, key=lambda r: (r[2], r[0]))
        if etag is not None:
            status = "resolved" if etag.replace("W/", "").replace('"', "") == ref[4] else "validator_mismatch"
        elif modified is not None:
            status = "resolved" if modified == ref[5] else "validator_mismatch"
        else:
            status = "unvalidated"
        merged = {"date": headers["date"], "server": ref[6]["server"]} if status in ("resolved", "unvalidated") else None
        out.append((rid, ref[0], status, merged))
    return sorted(out, key=repr)


def test_as_of_over_many_partitions_with_a_hot_url(spark):
    rows = records()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "4", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = wr.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert sorted([(r.record_id, r.refers_to, r.status, dict(sorted(r.headers.items())) if r.headers else None) for r in got], key=repr) == brute(rows)


def test_a_response_without_id_over_partition_borders(spark):
    rows = [("r0", "u", 0, True, "A", None, {"server": "old"}), (None, "u", 5, True, "B", None, {"server": "new"})]
    rows += [("n%02d" % i, "u", 10 + i, False, "B", None, {"date": str(i)}) for i in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "4", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = wr.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert len(got) == 60 and {(r.refers_to, r.status, r.headers["server"]) for r in got} == {(None, "resolved", "new")}


def test_canonical_urls(spark):
    urls = ["http://WWW.Example.org:80/a/b/?utm_source=x&z=1&b=2#top", "https://example.org/a/b?b=2&z=1", "example.org/a/b?z=1&b=2&ref=q", "", None, " "]
    got = [r[0] for r in spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").orderBy("i")
           .select(wr.canonical(F.col("u"))).collect()]
    assert got == ["example.org/a/b?b=2&z=1"] * 3 + [None] * 3


def test_edges(spark):
    rows = [("a", None, 1, True, None, None, None), ("b", None, 2, False, "x", None, None), ("c", "u", None, False, None, None, None),
            ("d", "u", 5, True, None, None, None), ("e", "u", 9, False, None, None, None), ("f", "u", 5, False, "x", None, {"date": "1"}),
            (None, "u", 10, False, "x", None, {"date": "1"})]
    got = {r.record_id: (r.refers_to, r.status) for r in wr.resolve(spark.createDataFrame(rows, SCHEMA).withColumn("pid", F.lit(1))).collect()}
    assert got == {"b": (None, "no_url"), "c": (None, "no_earlier"), "e": ("d", "unvalidated"), "f": (None, "no_earlier"), None: ("d", "validator_mismatch")}
    assert wr.resolve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pages_with_nulls_and_an_empty_table(spark):
    schema = "page_id long, url string, html string, at string"
    got = wr.resolve(wr.captures_of(spark.createDataFrame([(1, None, "x", ""), (2, "http://a/", None, "")], schema))).collect()
    assert len(got) == 4 and {r.status for r in got if r.url_key is None} == {"no_url"}
    assert wr.resolve(wr.captures_of(spark.createDataFrame([], schema))).count() == 0
