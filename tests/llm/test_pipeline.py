import random

import pytest

import corpus_pipeline
from churnscope.llm import exact_dedup, order_minhash, secrets_crf
from churnscope.llm.queries import ORACLE, QUERIES


def test_stages_on_edges(spark, edge_docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").where("1 = 0").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, edge_docs, str(tmp_path))
        assert out.columns == corpus_pipeline.COLUMNS
        rows = out.collect()
        assert rows and stage(spark, edge_docs.where("1 = 0"), str(tmp_path)).count() == 0
        if stage is corpus_pipeline.exact:
            texts = [exact_dedup_norm(r.text) for r in rows]
            assert len(texts) == len(set(texts)) == len({exact_dedup_norm(r.text) for r in edge_docs.collect()})
    # without labels every document has score 0.5 and none is kept
    assert corpus_pipeline.quality(spark, edge_docs, str(tmp_path)).count() == 0
    assert corpus_pipeline.packed(spark, edge_docs, str(tmp_path)).count() >= edge_docs.count()


def exact_dedup_norm(text):
    import re
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def test_run_follows_its_operators(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in QUERIES["op9_quality_qda"](spark, sf).where("predicted = 1").collect()}
    first = {}
    for i in sorted(good):
        first.setdefault(exact_dedup_norm(texts[i]), i)
    kept, runs = [], {}
    for i in sorted(first.values()):  # plain search for an earlier near copy
        words = texts[i].lower().split()
        if not any(order_minhash.linked(runs[j], words) for j in kept):
            kept.append(i)
        runs[i] = words
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == set(kept)
    have = {}
    for r in got:
        have[r.doc_id] = have.get(r.doc_id, 0) + r.length
    # a redacted text has no more words than before
    assert all(have[i] <= len(texts[i].split()) for i in kept)


def test_redacted_stage_has_no_base_match(spark):
    out = corpus_pipeline.secrets(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "")
    for r in out.collect():
        assert not any(secrets_crf.base_spans(r.text).values()) and r.n_chars == len(r.text)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == sorted(
        (tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()), key=repr)


def test_random_documents_through_dedup_stages(spark):
    rng = random.Random(11)
    rows = [(i, "t%d" % rng.randrange(4), None, None, None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.exact(spark, docs, "").count() == len({t for _, t, *_ in rows}) == exact_dedup.dedup(docs).where("kept").count()
