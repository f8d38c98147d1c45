"""Boosted trees and forests against plain NumPy, on any partitioning."""

import heapq
import math

import numpy as np
import pytest

from churnscope.operators import trees as tr

FEATURES = ["a", "b", "c"]


def table(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n).round(2), rng.integers(0, 6, n), rng.exponential(size=n)])
    y = (rng.random(n) < 1 / (1 + np.exp(-(2 * x[:, 0] + (x[:, 1] > 3) - 1)))).astype(int)
    return x, y


def frame(spark, x, y, folds=3):
    rows = [(i, int(c), i % folds, *map(float, r)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "CustomerID long, is_churned int, fold int, a double, b double, c double")


def fitted(spark, x, y, tasks, parts=3, fold=None, max_bins=32, shuffle=None):
    df = frame(spark, x, y).repartition(parts, "CustomerID" if shuffle is None else shuffle)
    edges = tr.bin_edges(df, FEATURES, max_bins)
    boosts = [t for t in tasks if isinstance(t.params, tr.Boost)]
    data = tr.blocks(df, FEATURES, edges, "is_churned", "CustomerID", fold, max(len(boosts), 1))
    counts = tr.class_counts(df, "is_churned", fold)
    return edges, (tr.boost(data, tasks, edges, counts, FEATURES) if boosts else tr.forest(data, tasks, edges, FEATURES))


def plain_tree(x, edges, g, h, w, p):
    """One tree by scanning every (feature, cut) of every leaf: nested tuples."""
    def best(rows, depth):
        found = (0.0, None, None)
        if (p.depth is not None and depth >= p.depth) or len(rows) < p.least_split:
            return found
        for f in range(x.shape[1]):
            for c in edges[f]:
                left, right = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                if min(len(left), len(right)) < max(p.least_rows, 1) or min(h[left].sum(), h[right].sum()) < p.least_hessian:
                    continue
                if p.gain == "friedman":
                    a, b = w[left].sum(), w[right].sum()
                    gain = a * b / (a + b) * (g[left].sum() / a - g[right].sum() / b) ** 2
                else:
                    part = lambda r: g[r].sum() ** 2 / (h[r].sum() + p.l2)
                    gain = part(left) + part(right) - part(rows)
                if gain > found[0] + 1e-9:
                    found = (gain, f, c)
        return found

    leaves, queue, splits = {0: np.flatnonzero(w > 0)}, [], {}
    depth, n = {0: 0}, 1
    push = lambda i: (s := best(leaves[i], depth[i]))[1] is not None and heapq.heappush(queue, (-s[0], i, s))
    push(0)
    while queue and len(leaves) < (p.leaves or 1 << 30):
        _, i, (gain, f, c) = heapq.heappop(queue)
        rows = leaves.pop(i)
        splits[i] = (f, c, n, n + 1)
        for side in (rows[x[rows, f] <= c], rows[x[rows, f] > c]):
            leaves[n], depth[n], n = side, depth[i] + 1, n + 1
            push(n - 1)
    value = {i: -p.rate * g[r].sum() / (h[r].sum() + p.l2) for i, r in leaves.items()}

    def shape(i):
        if i in splits:
            f, c, low, high = splits[i]
            return (f, float(c), shape(low), shape(high))
        return round(value[i], 4)

    def values(i, rows, out):
        if i in splits:
            f, c, low, high = splits[i]
            values(low, rows[x[rows, f] <= c], out)
            values(high, rows[x[rows, f] > c], out)
        else:
            out[rows] = value[i]
        return out
    return shape(0), values(0, np.arange(len(x)), np.zeros(len(x)))


def shape(t, i=0):
    if t.feature[i] < 0:
        return round(float(t.value[i]), 4)
    return (int(t.feature[i]), float(t.cut[i]), shape(t, t.left[i]), shape(t, t.right[i]))


def plain_boost(x, y, edges, task, fold=None):
    p, keep = task.params, np.ones(len(y), bool) if task.fold is None else fold != task.fold
    w = np.where(y == 1, task.weights[1], task.weights[0]) * keep
    margin, shapes = np.zeros(len(y)), []
    if p.from_mean:
        margin += math.log(w[y == 1].sum() / w[y == 0].sum())
    for _ in range(p.trees):
        q = 1 / (1 + np.exp(-margin))
        one, add = plain_tree(x, edges, w * (q - y), w * q * (1 - q), w, p)
        margin += add
        shapes.append(one)
    return shapes, 1 / (1 + np.exp(-margin))


VARIANTS = {
    "by level, weight on positives": tr.Task(tr.Boost(trees=3, depth=3), (1.0, 2.5)),
    "leaf-wise, no depth": tr.Task(tr.Boost(trees=3, depth=None, leaves=9, l2=0.0, least_hessian=1e-3, least_rows=5, from_mean=True), (0.8, 1.3)),
    "leaf-wise, depth": tr.Task(tr.Boost(trees=2, depth=4, leaves=7, l2=0.5)),
    "first order": tr.Task(tr.Boost(trees=3, depth=3, gain="friedman", l2=0.0, least_hessian=0.0, least_split=20, from_mean=True)),
}


def test_boosting_equals_a_plain_search(spark):
    x, y = table()
    tasks = list(VARIANTS.values())
    edges, models = fitted(spark, x, y, tasks)
    for (name, task), model in zip(VARIANTS.items(), models):
        want, probability = plain_boost(x, y, edges, task)
        assert [shape(t) for t in model.trees] == want, name
        assert np.abs(model.probability(x) - probability).max() < 1e-6, name


def test_leaf_wise_growth_keeps_its_budget_and_no_depth(spark):
    x, y = table(900, 5)
    edges, (model,) = fitted(spark, x, y, [tr.Task(tr.Boost(trees=12, depth=None, leaves=31, l2=0.0, least_hessian=1e-3, rate=0.3))], max_bins=128)
    leaves = [int((t.feature < 0).sum()) for t in model.trees]
    depth = lambda t, i=0: 0 if t.feature[i] < 0 else 1 + max(depth(t, t.left[i]), depth(t, t.right[i]))
    assert max(leaves) == 31 and max(map(depth, model.trees)) > 7


def test_trees_do_not_depend_on_the_partitioning(spark):
    x, y = table(700, 2)
    boost = [tr.Task(tr.Boost(trees=13, depth=3, rows=0.7, columns=0.7), (1.0, 2.0)), tr.Task(tr.Boost(trees=4, depth=None, leaves=6))]
    bags = [tr.Task(tr.Forest(trees=7, depth=6, least_rows=3, least_split=8), (0.7, 1.9))]
    for tasks in (boost, bags):
        _, first = fitted(spark, x, y, tasks, parts=1)
        _, second = fitted(spark, x, y, tasks, parts=5, shuffle="c")
        for a, b in zip(first, second):
            assert list(a.rows()) == list(b.rows()) and (a.importance == b.importance).all()
    assert len({t.feature.tobytes() for t in first[0].trees}) > 1


def test_folds_in_shared_passes_equal_separate_fits(spark):
    x, y = table(500, 3)
    fold = np.arange(len(y)) % 3
    tasks = [tr.Task(tr.Boost(trees=3, depth=3), (1.0, 1.5), k) for k in range(3)]
    edges, models = fitted(spark, x, y, tasks, fold="fold")
    for task, model in zip(tasks, models):
        want, _ = plain_boost(x, y, edges, task, fold)
        assert [shape(t) for t in model.trees] == want
    bags = [tr.Task(tr.Forest(trees=3, depth=4, least_rows=3), fold=k) for k in (None, 1)]
    edges, (whole, without) = fitted(spark, x, y, bags, fold="fold")
    df = frame(spark, x[fold != 1], y[fold != 1])
    rows = spark.createDataFrame([(int(i), int(y[i]), -1, *map(float, x[i])) for i in np.flatnonzero(fold != 1)], df.schema)
    alone = tr.forest(tr.blocks(rows, FEATURES, edges, "is_churned", "CustomerID", tasks=1), [tr.Task(tr.Forest(trees=3, depth=4, least_rows=3))], edges, FEATURES)[0]
    assert list(without.rows()) == list(alone.rows()) != list(whole.rows())


def test_forest_equals_a_plain_forest(spark):
    x, y = table(300, 4)
    task = tr.Task(tr.Forest(trees=4, depth=4, least_rows=4, least_split=10, columns=2), (0.8, 1.4))
    edges, (model,) = fitted(spark, x, y, [task])
    key = np.arange(len(y))
    w = np.array(task.weights)

    def impure(rows, bag):
        s = np.array([bag[rows][y[rows] == c].sum() for c in (0, 1)]) * w
        return s.sum() - (s ** 2).sum() / s.sum() if s.sum() else 0.0

    for number, t in enumerate(model.trees):
        bag = tr.bag(task.seed, number, key)
        todo = [(0, np.flatnonzero(bag))]
        for node, rows in todo:
            s = np.array([bag[rows][y[rows] == c].sum() for c in (0, 1)]) * w
            assert abs(t.value[node] - s[1] / s.sum()) < 1e-12
            if t.feature[node] < 0:
                continue
            options = []
            for f in tr.subset(task.seed, number, node, 3, 2):
                for c in edges[f]:
                    left, right = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                    if min(bag[left].sum(), bag[right].sum()) >= 4:
                        options.append((impure(rows, bag) - impure(left, bag) - impure(right, bag), f, c))
            best = max(o[0] for o in options)
            f, c = t.feature[node], t.cut[node]
            assert abs(t.gain[node] - best) < 1e-9 and any(o[1] == f and o[2] == c and o[0] > best - 1e-9 for o in options)
            todo += [(t.left[node], rows[x[rows, f] <= c]), (t.right[node], rows[x[rows, f] > c])]


def test_bins_are_exact_for_few_values_and_even_for_many(spark):
    rng = np.random.default_rng(0)
    values = [[float(v) for v in (-2, -2, 0, 0, 1, 1.5, 1e9, 7)], rng.normal(size=20_000).tolist()]
    df = spark.createDataFrame([(values[0][i % 8], values[1][i]) for i in range(20_000)] + [(None, float("nan")), (float("inf"), None)], "a double, b double")
    a, b = tr.bin_edges(df, ["a", "b"], 16)
    assert a.tolist() == [-1.0, 0.5, 1.25, 4.25, 500000003.5]
    shares = np.histogram(values[1], [-np.inf, *b, np.inf])[0] / 20_000
    assert len(b) == 15 and abs(shares - 1 / 16).max() < 0.01


def test_saved_models_and_missing_values(spark, tmp_path):
    x, y = table(200, 6)
    df = frame(spark, x, y)
    _, models = fitted(spark, x, y, [tr.Task(tr.Boost(trees=3, depth=3))])
    models[0].save(spark, str(tmp_path))
    again = tr.TreeModel.load(spark, str(tmp_path))
    assert list(again.rows()) == list(models[0].rows()) and again.features == FEATURES
    got = [r[0] for r in df.orderBy("CustomerID").select(tr.probability_column(again)).collect()]
    assert np.abs(np.array(got) - models[0].probability(x)).max() < 1e-12
    odd = spark.createDataFrame([(1, None, 1.0, 1.0), (2, float("nan"), 1.0, 1.0)], "CustomerID long, a double, b double, c double")
    assert all(0 < r[0] < 1 for r in odd.select(tr.probability_column(again)).collect())
    assert df.where("1 = 0").select(tr.probability_column(again)).count() == 0
    with pytest.raises(ValueError):
        none = df.where("1 = 0")
        data = tr.blocks(none, FEATURES, [np.zeros(0)] * 3, "is_churned", "CustomerID")
        tr.boost(data, [tr.Task(tr.Boost(trees=1))], [np.zeros(0)] * 3, {}, FEATURES)


def test_rows_of_one_file_are_dealt_to_all_cores(spark):
    x, y = table(3 * tr.FEW_ROWS, 7)
    df = frame(spark, x, y).coalesce(1)
    data = tr.blocks(df, FEATURES, tr.bin_edges(df, FEATURES, 8), "is_churned", "CustomerID")
    assert data.getNumPartitions() == min(3, spark.sparkContext.defaultParallelism) > 1
    assert sum(len(b.y) for b in data.collect()) == len(y)


def test_no_histogram_comes_to_the_driver(spark, monkeypatch):
    import pickle

    from pyspark import RDD
    sent, collect = [], RDD.collect

    def counted(self):
        out = collect(self)
        sent.append(len(pickle.dumps(out)))
        return out

    monkeypatch.setattr(RDD, "collect", counted)
    x, y = table(2000, 8)
    fitted(spark, x, y, [tr.Task(tr.Boost(trees=2, depth=4))], max_bins=128)
    fitted(spark, x, y, [tr.Task(tr.Forest(trees=2, depth=4))], max_bins=128)
    # one node's histogram would be 3 features x some 100 bins x 4 doubles
    assert sent and max(sent) < 8 * 1000


def test_what_a_worker_knows_changes_nothing():
    x, y = table(300, 9)
    bins = np.asfortranarray(np.column_stack([np.searchsorted(np.quantile(c, np.arange(1, 16) / 16), c) for c in x.T]).astype(np.uint8))
    block = tr.Block(bins, y.astype(np.uint8), np.arange(300), np.zeros(300, np.int16), np.zeros((1, 300)))
    grown = [tr.Nodes(*(np.array(c) for c in ([f, -1, -1], [7, 0, 0], [1, -1, -1], [2, -1, -1], [0.0, v, -v], [0.0] * 3))) for f, v in ((0, 0.3), (1, 0.7), (2, 0.11))]
    task = tr.Task(tr.Boost(), (1.0, 2.0))
    for n in (1, 2, 2, 3, 1):
        got = tr._gradients(block, 0, task, 0.1, grown[:n], n, 2.0 ** 30, "a")
        tr._known.clear() if n == 3 else None
        fresh = tr._gradients(block, 0, task, 0.1, grown[:n], n, 2.0 ** 30, f"b{n}")
        assert all((a == b).all() for a, b in zip(got, fresh))
        tr._gradients(block, 0, task, 0.1, grown[:n], n, 2.0 ** 30, "a")


def test_small_nodes_grown_by_a_reducer_equal_passes_to_the_leaves(spark, monkeypatch):
    x, y = table(700, 10)
    tasks = [*VARIANTS.values(), tr.Task(tr.Boost(trees=12, depth=4, rows=0.6), (1.0, 2.0)), tr.Task(tr.Boost(trees=2, depth=5), fold=1)]
    passes, found = [], tr._found
    monkeypatch.setattr(tr, "_found", lambda *a: passes.append(a) or found(*a))
    seen = {}
    for most in (0, 60, 1 << 17):
        monkeypatch.setattr(tr, "LOCAL_ROWS", most)
        passes.clear()
        _, models = fitted(spark, x, y, tasks, fold="fold")
        seen[most] = ([list(m.rows()) for m in models], [m.importance.tolist() for m in models], len(passes))
    assert seen[0][:2] == seen[60][:2] == seen[1 << 17][:2]
    # a small table takes one pass a tree, not one a level
    assert seen[1 << 17][2] == 12 < seen[60][2] <= seen[0][2]
    # no reducer gets a node of more rows than that
    monkeypatch.setattr(tr, "LOCAL_ROWS", 60)
    passes.clear()
    fitted(spark, x, y, tasks, fold="fold")
    assert 0 < max(n for a in passes for n in a[4]) <= 60


def test_small_nodes_are_spread_by_their_rows():
    at = tr._spread([16_000, 10, 16_000, 20, 9_000, 30], 8)
    assert len({at[0], at[2], at[4]}) == 3 and max(at) < 8
    assert tr._spread([], 8) == [] and set(tr._spread([5, 6], 8)) == {0}
    many = tr._spread([tr.LOCAL_ROWS] * 100, 4)
    load = np.bincount(many) * tr.LOCAL_ROWS
    assert load.max() <= tr.MOST_GROWN + tr.LOCAL_ROWS and len(load) > 4


def test_a_subtree_sums_the_rows_of_smaller_children_only(monkeypatch):
    n, depth, unit, n_bins = 4000, 6, 2.0 ** 30, [16, 16, 16]
    rng = np.random.default_rng(5)
    bins, y = np.asfortranarray(rng.integers(0, 16, (n, 3)).astype(np.uint8)), (rng.random(n) < 0.4).astype(np.uint8)
    g, h = np.rint(rng.normal(size=n) * unit) / unit, np.rint(rng.random(n) * unit) / unit
    task, allowed = tr.Task(tr.Boost(trees=1, depth=depth, l2=0.5, least_hessian=0.0), (1.0, 2.0)), np.ones(3, bool)
    values = [g, h, 1.0 + y * float(tr.PAIR)]

    plain = tr._Growing(task.params, allowed)
    while plain.wanted:
        at, found = tr.route(plain.frozen(), bins), []
        for node in plain.wanted:
            on = np.flatnonzero(at == node)
            found.append(tr._split([(task, allowed)], n_bins, unit, 0, tr._histograms(np.zeros(len(on), int), 1, list(bins[on].T), [v[on] for v in values], n_bins)[0]))
        plain.learn(found)

    summed, histograms = [], tr._histograms
    monkeypatch.setattr(tr, "_histograms", lambda mine, *a: summed.append(len(mine)) or histograms(mine, *a))
    got = tr._subtree([(task, allowed, 0)], n_bins, unit, 0, [(bins[:1500].tobytes(), g[:1500], h[:1500], y[:1500]), (bins[1500:].tobytes(), g[1500:], h[1500:], y[1500:])])
    for a, b in zip(got, plain.splits()):
        assert np.array_equal(a, b)
    assert sum(summed) <= n + (depth - 1) * n / 2


def test_one_stage_for_all_trees_equals_a_job_a_pass(spark, monkeypatch):
    x, y = table(3000, 10)
    x[:, 1] = np.where(np.arange(len(x)) % 20 < 19, 2.0, x[:, 1])      # most rows in one bin
    tasks = [*VARIANTS.values(), tr.Task(tr.Boost(trees=12, depth=4, rows=0.6), (1.0, 2.0)), tr.Task(tr.Boost(trees=23, depth=5), fold=1)]
    monkeypatch.setattr(tr, "FEW_ROWS", 500)
    jobs, found, seen = [], tr._found, []
    monkeypatch.setattr(tr, "_found", lambda *a: jobs.append(a) or found(*a))
    for rows in (0, 200, 1 << 17):
        monkeypatch.setattr(tr, "STAGE_ROWS", rows)
        seen.append(fitted(spark, x, y, tasks, fold="fold")[1])
    assert not jobs
    monkeypatch.setattr(tr, "KEPT_BYTES", 0)      # what doesn't fit the tasks goes by passes
    seen.append(fitted(spark, x, y, tasks, fold="fold")[1])
    assert jobs
    for models in zip(*seen):
        for a, b in zip(models, models[1:]):
            assert list(a.rows()) == list(b.rows()) and (a.importance == b.importance).all()


def test_sums_by_column_are_those_of_the_histograms():
    rng, n, n_bins = np.random.default_rng(4), 5000, [7, 3, 2, 100]
    bins = np.asfortranarray(np.column_stack([rng.integers(0, b, n) for b in n_bins]).astype(np.uint8))
    bins[:, 1], bins[:, 2] = np.where(np.arange(n) % 10, 1, bins[:, 1]), np.arange(n) < 20
    values = [np.rint(rng.normal(size=n) * 2.0 ** 30) / 2.0 ** 30 for _ in range(2)] + [1.0 + (rng.random(n) < 0.3) * float(tr.PAIR)]
    columns = tr._Columns(tr.Block(bins, np.zeros(n, np.uint8), np.arange(n), np.zeros(n, np.int16), np.zeros((0, 0))), n_bins)
    for rows in (np.arange(n), np.arange(20, n, 3), np.arange(0)):
        plain = [np.concatenate([np.bincount(c[rows], v[rows], b) for c, b in zip(bins.T, n_bins)]) for v in values]
        assert np.array_equal(columns.of(rows, values), plain)
    both = columns.of_all(values[0] + 1j * values[1])
    assert np.array_equal([both.real, both.imag], [np.concatenate([np.bincount(c, v, b) for c, b in zip(bins.T, n_bins)]) for v in values[:2]])
