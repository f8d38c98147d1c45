import random

import pandas as pd

from churnscope.llm import packing


def test_best_fit_against_a_plain_search():
    rng = random.Random(3)
    pieces = pd.DataFrame([(rng.randrange(0, 60), "s%d" % min(rng.randrange(6), 3), "c%d" % rng.randrange(150), i, 0) for i in range(400)],
                          columns=["length", "source", "cluster", "doc_id", "piece"])
    got = packing.pack_shard(pieces, 100, 2)
    bins = []
    for r in got.itertuples():  # in packing order
        fits = [(100 - sum(x.length for x in b), n) for n, b in enumerate(bins)
                if 100 - sum(x.length for x in b) >= r.length and sum(x.source == r.source for x in b) < 2
                and all(x.cluster != r.cluster for x in b)]
        n = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
        assert r.bin == n and r.bin_offset == sum(x.length for x in bins[n])
        bins[n].append(r)


def test_edges_keep_every_word_and_all_rules(edge_docs, edge_rows):
    got = packing.pack(edge_docs, capacity=500, shard=7).collect()
    want = {}
    for i, t in edge_rows:
        n = len([w for w in t.replace("\t", " ").replace("\n", " ").split(" ") if w])
        want.setdefault(i, []).append(n)
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append(r.length)
    assert {k: sum(v) for k, v in have.items()} == {k: sum(v) for k, v in want.items()}
    source = {i: (None if i == 10 else (i or 0) % 2) for i in have}
    for b in {(r.shard, r.bin) for r in got}:
        rows = sorted((r for r in got if (r.shard, r.bin) == b), key=lambda r: (r.bin_offset, r.length))
        assert sum(r.length for r in rows) <= 500
        assert all(x.bin_offset + x.length <= y.bin_offset for x, y in zip(rows, rows[1:]))
        sources = [source[r.doc_id] for r in rows]
        assert all(sources.count(s) <= packing.PER_SOURCE for s in sources)
        assert len({4 if r.doc_id == 5 else r.doc_id for r in rows}) == len(rows)  # copies and repeated rows are apart


def test_rows_that_repeat_a_doc_id_are_apart(spark):
    rows = [(7, "a b", "s"), (7, "c d e", "t"), (8, "f", "u"), (None, "g h", "v"), (None, "i", "w")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len({r.bin for r in got if r.doc_id == 7}) == 2
    assert len({(r.shard, r.bin) for r in got}) == 2  # null is no repeated id


def test_a_given_cluster_column(edge_docs):
    got = packing.pack(edge_docs, cluster="tid").collect()  # one cluster for all: every piece has its own bin
    assert len({(r.shard, r.bin) for r in got}) == len(got)


def test_empty_table(no_docs):
    assert packing.pack(no_docs).count() == 0
