"""Queries of the corpus operators: each takes (spark, sf_dir), applies its
operator with production parameters to the whole table and returns the whole
result. ``ORACLE`` has DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm import (
    ann_tree, centroids, chat_prefixes, exact_dedup, hard_negatives, order_minhash, packing, quality_qda, secrets_crf,
    sentencepiece_viterbi, suffix_dedup, toxicity_fst, warc_revisit)
from churnscope.llm.common import documents, labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@_query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(documents(spark, sf_dir)).drop("locator")


ORACLE["op8_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
     g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)
"""


@_query
def op9_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.score(documents(spark, sf_dir), labels(spark, sf_dir))


@_query
def op10_secrets_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secrets_crf.scan(docs, secrets_crf.train(docs))


@_query
def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(documents(spark, sf_dir))


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


@_query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(documents(spark, sf_dir))


@_query
def op4_kmeans_tree_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@_query
def op6_toxicity_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity_fst.score(docs, toxicity_fst.train(docs, labels(spark, sf_dir)))


@_query
def op5_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.decode_column(sentencepiece_viterbi.encode(documents(spark, sf_dir)))


@_query
def op7_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisit.resolve(warc_revisit.captures_of(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    lines = F.transform(F.array_sort(F.map_keys("headers")), lambda k: F.concat(k, F.lit("="), F.element_at("headers", k)))
    return found.select("record_id", "url_key", "refers_to", "status", F.array_join(lines, "|").alias("headers"))


ORACLE["op7_warc_revisit"] = r"""
WITH p AS (SELECT page_id AS p, url, md5(coalesce(html, '')) AS h, 1704067200 + (page_id * 7919) % 2592000 AS t FROM pages),
f AS (SELECT 'f' || p || '-' || v AS record_id, url, t + v * 400000 AS ts, substr(md5(h || v), 1, 16) AS etag,
             CAST(t + v * 400000 - 3600 AS VARCHAR) AS modified, 's' || v AS server
      FROM p, unnest(range(0, p % 3 + 1)) AS u(v)),
n0 AS (SELECT *, t - 500 + (p * 104729 + v * 611953) % 1296000 AS ts FROM p, unnest([0, 1]) AS u(v)),
n1 AS (SELECT *, least(p % 3, CAST(floor(greatest(ts - t - 1, 0) / 400000) AS BIGINT)) AS held FROM n0),
n AS (SELECT 'n' || p || '-' || v AS record_id, url || '#again' AS url, ts,
             CASE p % 5 WHEN 0 THEN 'W/"' || substr(md5(h || held), 1, 16) || '"' WHEN 1 THEN 'x' || substr(md5(h || held), 1, 16)
                        WHEN 4 THEN substr(md5(h || held), 1, 16) END AS etag,
             CASE p % 5 WHEN 2 THEN CAST(t + held * 400000 - 3600 AS VARCHAR) END AS modified FROM n1),
b AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
      FROM (SELECT record_id, url, ts, etag, modified, server FROM f UNION ALL SELECT record_id, url, ts, etag, modified, NULL FROM n)),
q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
                lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS kept FROM b),
k AS (SELECT record_id, ts, etag, modified, server,
             CASE WHEN trim(url) <> '' THEN
               regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
               || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
               || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS url_key FROM q),
j AS (SELECT n.record_id, n.url_key, n.ts, n.etag, n.modified, r.record_id AS refers_to, r.etag AS r_etag, r.modified AS r_modified, r.server,
             row_number() OVER (PARTITION BY n.record_id ORDER BY r.ts DESC NULLS LAST, r.record_id DESC) AS i
      FROM (SELECT * FROM k WHERE record_id LIKE 'n%') n
      LEFT JOIN (SELECT * FROM k WHERE record_id LIKE 'f%') r ON n.url_key = r.url_key AND r.ts < n.ts),
s AS (SELECT *, CASE WHEN url_key IS NULL THEN 'no_url' WHEN refers_to IS NULL THEN 'no_earlier'
                WHEN etag IS NOT NULL THEN CASE WHEN replace(regexp_replace(etag, '^W/', ''), '"', '') = r_etag THEN 'resolved' ELSE 'validator_mismatch' END
                WHEN modified IS NOT NULL THEN CASE WHEN modified = r_modified THEN 'resolved' ELSE 'validator_mismatch' END
                ELSE 'unvalidated' END AS status FROM j WHERE i = 1)
SELECT record_id, url_key, refers_to, status,
       CASE WHEN status IN ('resolved', 'unvalidated') THEN
         'cache-control=max-age=90|content-type=text/html|date=' || ts || '|etag=' || r_etag || '|server=' || server END AS headers
FROM s
"""


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.integers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label))


ORACLE["op11_hard_negatives"] = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@_query
def op12_chat_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.sql("""SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
                         FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)""")
    return chat_prefixes.read_back(chat_prefixes.expand(table.unionByName(added)))


ORACLE["op12_chat_prefixes"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g') AS escaped FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(role) + length(escaped)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@_query
def op13_ns_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = centroids.integers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    state, history = centroids.cluster(rows)
    return centroids.report(state, history[-1])


def _rounds_sql(rounds: int) -> str:
    """The same k-means without bounds: every distance of every round."""
    near = """
a{n} AS (SELECT row, vec_id, x, j, d FROM (
    SELECT p.row, p.vec_id, p.x, c.j, CAST(list_sum(list_transform(range(1, 65), lambda i: (p.x[i] - c.m[i]) * (p.x[i] - c.m[i]))) AS BIGINT) AS d
    FROM p CROSS JOIN c{n} c) QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, j) = 1)"""
    move = """,
m{n} AS (SELECT j, list(m ORDER BY i) AS m FROM (
    SELECT j, i, CAST(floor(sum(x[i])::DOUBLE / count(*)) AS BIGINT) AS m FROM a{n}, range(1, 65) t(i) GROUP BY j, i) GROUP BY j),
c{o} AS (SELECT c{n}.j, coalesce(m{n}.m, c{n}.m) AS m FROM c{n} LEFT JOIN m{n} USING (j)),"""
    return "".join(near.format(n=n) + move.format(n=n, o=n + 1) for n in range(rounds)) + near.format(n=rounds)


ORACLE["op13_ns_bounds"] = f"""
WITH p AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS j, x AS m FROM p QUALIFY j < 16),
{_rounds_sql(centroids.ROUNDS)}
SELECT vec_id, CAST(a{centroids.ROUNDS}.j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a{centroids.ROUNDS}.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{centroids.ROUNDS} JOIN c{centroids.ROUNDS} USING (j)
"""
