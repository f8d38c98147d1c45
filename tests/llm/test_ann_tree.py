import numpy as np
import pytest

from churnscope.llm import ann_tree as at


def vectors(spark, n=1500, d=12, hot=400):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(n, d)).astype(np.float32).astype(float)
    x[:hot] = x[0]
    rows = [(int(i), [float(c) for c in v], "z", "z") for i, v in enumerate(x)]
    bad = [(2000, None), (2020, []), (2040, [0.0] * d), (2060, [float("nan")] + [1.0] * (d - 1)), (2080, [None] + [1.0] * (d - 1)),
           (2100, [float("inf")] * d), (2120, [1.0] * (d - 1)), (None, [1.0] * d)]
    rows += [(i, v, "z", "z") for i, v in bad] + [rows[7], rows[20]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, leaf string, v string"), x


def exact(x, q, k):
    s = at.inner(x[q], x)
    ids = np.array([i for i in np.lexsort((np.arange(len(x)), -s)) if i != q])[:k]
    return [(int(i), float(s[i])) for i in ids]


def test_all_leaves_give_the_exact_answer(spark):
    df, x = vectors(spark)
    got = at.search(df, block=150, visits=10 ** 6).collect()
    for q in range(0, 1500, 20):
        mine = sorted([(r.rank, r.vec_id, r.score) for r in got if r.query_id == q])
        assert [m[0] for m in mine] == list(range(1, 21))
        assert [(m[1], m[2]) for m in mine] == exact(x, q, 20)
    assert {r.query_id for r in got} == set(range(0, 1500, 20))


def test_calibrated_recall(spark):
    df, x = vectors(spark, hot=1)
    got = at.search(df, sample=700).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len(found[q] & {i for i, _ in exact(x, q, 20)}) for q in range(0, 1500, 20)]
    assert np.mean(hits) / 20 >= 0.9


@pytest.mark.parametrize("visits", [1, None])
def test_clusters_and_outliers_give_every_rank(spark, visits):
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(120, 12)) * 10, 10, axis=0) + rng.normal(size=(1200, 12)) * 0.01
    x[::100] *= 40  # outliers get leaves of their own
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    ranks = {}
    for r in at.search(df, visits=visits).collect():
        ranks.setdefault(r.query_id, []).append(r["rank"])
    assert set(ranks) == set(range(0, 1200, 20))
    assert all(sorted(v) == list(range(1, 21)) for v in ranks.values())


def test_few_and_no_rows(spark):
    df, _ = vectors(spark)
    few = at.search(df.where("vec_id < 5")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in few) == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 4)]
    assert at.search(df.where("1 = 0")).count() == 0
    assert at.search(df.where("vec_id = 0")).count() == 0


def test_tree_visits_every_leaf_once():
    x = np.random.default_rng(1).normal(size=(900, 6))
    tree = at.fit(x, leaf=20)
    assert sorted(tree.best_bins(x[0], 10 ** 6)) == list(range(tree.n_leaves))
    assert np.bincount(tree.leaf_of(x), minlength=tree.n_leaves).sum() == 900
    same = at.fit(np.ones((500, 4)))
    assert same.n_leaves == 1


@pytest.mark.parametrize("counts", [[5, 5, 5], [100, 1, 1], [0, 0, 40, 3]])
def test_groups_hold_blocks_of_bounded_size(counts):
    group, blocks = at.group_leaves(np.array(counts), 10)
    held = np.bincount(group, weights=counts, minlength=len(blocks))
    assert (held <= 10 * blocks).all() and (np.diff(group) >= 0).all()
