import hashlib
import math
import random

import numpy as np
import pytest

from churnscope.llm import centroids

SCHEMA = "vec_id long, label int, embedding array<float>, x string, cluster string, kept string, since string, distance string"


def table(spark, rows):
    return spark.createDataFrame([(i, None, e and [None if c is None else float(c) for c in e], *["z"] * 5) for i, e in rows], SCHEMA)


def brute(rows, k=16, rounds=3, length=4):
    ok = [(i, [math.floor(64 * float(np.float32(c))) for c in e]) for i, e in rows
          if e is not None and len(e) == length and all(c is not None and math.isfinite(c) for c in e)]
    key = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    c = [v for _, v in sorted(ok, key=key)[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for n in range(rounds + 1):
        at = [min(range(len(c)), key=lambda j: (dist(v, c[j]), j)) for _, v in ok]
        for j in range(len(c)) if n < rounds else []:
            mine = [v for (_, v), a in zip(ok, at) if a == j]
            c[j] = [sum(col) // len(mine) for col in zip(*mine)] if mine else c[j]
    d = [dist(v, c[a]) for (_, v), a in zip(ok, at)]
    return sorted(((str(i), a, x, sum(y for y, b in zip(d, at) if a == b), sum(d), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest())
                   for (i, _), a, x in zip(ok, at, d)))


def clustered(df, rounds=3, length=4):
    state, history = centroids.cluster(centroids.integers(df, length=length), rounds=rounds)
    got = centroids.report(state, history[-1]).collect() if history.size else []
    return sorted((str(r[0]), *r[1:]) for r in got), state


def test_against_plain_k_means(spark):
    rng = random.Random(1)
    middles = [[rng.uniform(-2, 2) for _ in range(4)] for _ in range(20)]
    rows = [(i, [m + rng.gauss(0, 0.2) for m in middles[i % 20]]) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]                      # a third of all rows
    rows += [(7, rows[9][1]), (7, rows[9][1]), (None, rows[5][1]), (None, rows[6][1])]
    rows += [(2000, None), (2001, []), (2002, rows[0][1][:3]), (2003, [None, 0.0, 0.0, 0.0]), (2004, [float("nan"), 0, 0, 0]), (2005, [float("inf"), 0, 0, 0])]
    df = table(spark, rows)
    for rounds in (0, 3, 6):
        got, state = clustered(df, rounds)
        assert got == brute(rows, rounds=rounds)
    # most distances of the later rounds are never computed
    assert state.agg({"evaluated": "sum"}).first()[0] < 0.5 * 16 * 7 * len(got)


def test_few_equal_and_no_rows(spark):
    same = [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(30)]
    assert clustered(table(spark, same))[0] == brute(same)
    few = [(i, [i / 3, -i, 0.1, 2.0]) for i in range(5)]
    assert clustered(table(spark, few))[0] == brute(few)
    assert clustered(table(spark, few).where("1 = 0"))[0] == []


def test_components_beyond_64_bit_distances_raise(spark):
    with pytest.raises(Exception, match="2\\*\\*27"):
        clustered(table(spark, [(1, [3e9, 0.0, 0.0, 0.0])]))


def test_bounds_use_the_total_displacement():
    # a centroid that goes away and comes back has not moved at all
    history = np.array([[[0, 0]], [[30, 40]], [[0, 0]]])
    assert centroids.moved(history).tolist() == [[0.0], [50.0], [0.0]]
    history = np.array([[[0, 0], [100, 0]], [[3, 4], [100, 0]], [[0, 0], [100, 0]]])
    x = np.array([[10, 0], [60, 0]])
    kept = np.sqrt(((x[:, None] - history[0][None]) ** 2).sum(axis=2).astype(float))
    cluster, _, since, used = centroids.assign(x, np.array([0, 1]), kept, np.zeros((2, 2), np.int32), history)
    assert cluster.tolist() == [0, 1] and used.tolist() == [0, 0] and since.tolist() == [[0, 0], [0, 0]]
