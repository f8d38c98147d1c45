import math
import random

import numpy as np
import pytest

from churnscope.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>, uid string, v string, d string, key string"


def table(spark, rows):
    return spark.createDataFrame([(i, l, e, "z", "z", "z", "z") for i, l, e in rows], SCHEMA)


def brute(rows, every=100, positives=5, negatives=10, least=30, most=90):
    ok = [(n, i, l, [math.floor(256 * float(np.float32(c))) for c in e]) for n, (i, l, e) in enumerate(rows)
          if i is not None and l is not None and e is not None and all(c is not None and math.isfinite(c) for c in e)]
    out = []
    for n, i, l, q in ok:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, m, k) for k, j, m, v in ok if k != n and len(v) == len(q))
        for s, j, _, _ in [x for x in scored if x[2] == l][:positives]:
            taken = [(t, o) for t, o, m, _ in scored if m != l and least * -s <= 100 * -t <= most * -s][:negatives]
            out += [(i, j, r + 1, o, -s, -t) for r, (t, o) in enumerate(taken)]
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in hn.mine(hn.integers(df), **kw).collect())


def test_against_brute_force_in_small_blocks(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), [rng.uniform(-1, 1) for _ in range(6)]) for i in range(220)]
    rows += [(300 + i, i % 2, rows[10][2]) for i in range(120)]      # one vector, a third of all rows
    rows += [(5, 1, rows[5][2]), (20, 0, rows[6][2]), (20, 0, rows[6][2])]   # repeated ids, an anchor among them
    rows += [(500, 0, [0.0] * 6), (501, 0, [0.0] * 6), (502, 1, [0.0] * 6)]   # scores of 0
    df = table(spark, rows)
    want = brute(rows, every=20)
    assert want and any(r[4] == 0 for r in want)
    assert mined(df, every=20, row_block=40, anchor_block=5, partitions=3) == want
    assert mined(df, every=20) == want


def test_rows_that_take_no_part(spark):
    e = [0.5, 0.25]
    rows = [(0, 1, e), (1, 1, e), (2, 2, [0.2, 0.2]), (3, None, e), (None, 1, e), (4, 1, None), (5, 2, [None, 0.1]), (6, 2, [float("nan"), 0.1]),
            (7, 2, [float("inf"), 0.1]), (8, 2, [0.25]), (9, 2, []), (100, 3, []), (200, 1, [0.25])]
    assert mined(table(spark, rows)) == brute(rows) and brute(rows)
    assert mined(table(spark, rows).where("1 = 0")) == []


def test_large_products_are_exact_or_raise(spark):
    rows = [(0, 1, [8.0e6, 1.0]), (1, 1, [7.0e6, 1.0]), (2, 2, [4.0e6, 3.0]), (3, 2, [4.0e6, 4.0])]
    assert mined(table(spark, rows)) == brute(rows) and brute(rows)
    with pytest.raises(OverflowError):
        hn.products(np.array([[2.0 ** 60]]), np.array([[2.0 ** 60]]))


def test_keys_sort_as_their_parts():
    parts = [(a, s, k, i) for a in (-5, 0, 7) for s in (2 ** 62, 3, 0, -1, -2 ** 62) for k in (0, 1) for i in (-9, 0, 2 ** 40)]
    keys = [hn.pack(np.array([a]), np.array([s]), k, np.array([i]))[0] for a, s, k, i in parts]
    assert [hn.unpack(k) for k in sorted(keys)] == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))
    assert [hn.unpack(k) for k in keys] == parts


def test_windows_stream_and_close():
    pairs = [(0, 100, False, 1), (0, 100, False, 2), (0, 91, True, 3), (0, 90, True, 4), (0, 80, False, 5), (0, 72, True, 6), (0, 30, True, 7), (0, 29, True, 8)]
    keys = [hn.pack(np.array([a]), np.array([s]), k, np.array([i]))[0] for a, s, k, i in pairs]
    got = list(hn.windows(iter(keys), 2, 30, 90))
    assert [(r[1], r[2], r[3]) for r in got] == [(1, 1, 4), (2, 1, 4), (1, 2, 6), (2, 2, 6), (5, 1, 6), (5, 2, 7)]
