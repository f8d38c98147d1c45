import hashlib
import re

from pyspark.sql import functions as F

from churnscope.llm import exact_dedup


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t), []).append(i)
    out = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_edges_in_several_batches(edge_docs, edge_rows):
    got = exact_dedup.dedup(edge_docs.repartition(5), files_per_batch=1).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == expected(edge_rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})  # one row of each text, repeated rows included
    assert all(r.doc_id == r.keep_id for r in kept)


def test_digest_collisions_are_split_by_text(edge_docs, edge_rows):
    weak = exact_dedup.dedup(edge_docs, digest=lambda c: (F.length(c) % 2).cast("string").cast("binary"))
    got = sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in weak.collect()], key=repr)
    assert got == expected(edge_rows)


def test_empty_table(no_docs):
    assert exact_dedup.dedup(no_docs).count() == 0


def rows_of(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()], key=repr)


def test_deliveries_and_a_restart_give_the_rows_of_one_run(spark, tmp_path, edge_docs, edge_rows):
    state = f"{tmp_path}/state"
    later = spark.createDataFrame([(-5, "new text"), (-6, edge_rows[0][1]), (900, "new \n text")], "doc_id long, text string")
    first = exact_dedup.dedup(edge_docs.repartition(3), state=state, delivery="a")
    assert rows_of(first) == expected(edge_rows)
    # the second call dies after its table is written and before the stream runs
    stream, exact_dedup.digest_state = exact_dedup.digest_state, None
    try:
        exact_dedup.dedup(later, state=state, delivery="b")
    except TypeError:
        pass
    finally:
        exact_dedup.digest_state = stream
    want = expected(edge_rows + [(r.doc_id, r.text) for r in later.collect()])
    assert rows_of(exact_dedup.dedup(later, state=state, delivery="b")) == want
    again = exact_dedup.dedup(later, state=state, delivery="b")  # delivered twice, counted once
    assert rows_of(again) == want
    assert again.where("kept").count() == len({w[3] for w in want})
    changes = spark.read.parquet(f"{state}/changes")
    assert changes.groupBy("digest").agg(F.countDistinct("batch").alias("n")).where("n > 1").count()  # state was met again


def test_collisions_across_deliveries_are_split_by_text(spark, tmp_path):
    weak = dict(digest=lambda c: (F.length(c) % 2).cast("string").cast("binary"), state=f"{tmp_path}/state")
    rows = [(1, "aa"), (2, "bb"), (3, "a"), (4, "aa"), (0, "bb")]
    for i, part in enumerate((rows[:2], rows[2:])):
        got = exact_dedup.dedup(spark.createDataFrame(part, "doc_id long, text string"), delivery=str(i), **weak)
    assert rows_of(got) == expected(rows)


def test_one_table_goes_through_several_batches(spark, tmp_path, edge_docs, edge_rows):
    state = f"{tmp_path}/state"
    exact_dedup.dedup(edge_docs.repartition(6), state=state, delivery="x")
    assert spark.read.parquet(f"{state}/changes").select("batch").distinct().count() >= 2
