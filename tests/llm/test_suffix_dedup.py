import hashlib
import random
from collections import Counter

import numpy as np

from churnscope.llm import suffix_dedup as sd


def brute(rows, length):
    seen = Counter(b[p:p + length] for _, b in rows for p in range(len(b) - length + 1))
    out = []
    for i, b in rows:
        spans = sd.merge([[p, p + length] for p in range(len(b) - length + 1) if seen[b[p:p + length]] > 1])
        out.append((i, len(b), sum(e - s for s, e in spans), len(spans), hashlib.sha256(sd.cut(b, spans)).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()], key=repr)


def test_edges(edge_docs, edge_rows):
    assert result(sd.repeats(edge_docs)) == brute([(i, t.encode()) for i, t in edge_rows], 400)


def test_hot_anchor_by_digest_and_periodic_texts(spark):
    rng = random.Random(1)
    shared = "".join(rng.choice("abcd ") for _ in range(700))
    texts = [shared[:500 + k] + "".join(rng.choice("xyz") for _ in range(300)) + shared[k:] for k in range(12)]
    texts += ["ab" * 450, "é" * 300, "q" * 399, "r" * 400, "r" * 401, shared[100:480]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute([(i, t.encode()) for i, t in rows], 400)
    assert result(sd.repeats(docs)) == want
    assert result(sd.repeats(docs, hot_segments=2)) == want


def test_column_rounds_give_suffix_order_and_common_prefixes():
    rng = np.random.default_rng(2)
    columns = rng.integers(0, 3, (40, 30)).astype(np.int16)
    columns[::7, 20:] = -1
    group = np.sort(rng.integers(0, 4, 40))
    for c, order, prefix in sd.column_rounds(columns, group):
        suffixes = [(group[i], columns[i, c:].tolist()) for i in order]
        assert suffixes == sorted(suffixes)
        for k in range(1, len(order)):
            (ga, a), (gb, b) = suffixes[k - 1], suffixes[k]
            n = 0
            while ga == gb and n < len(a) and a[n] == b[n] >= 0:
                n += 1
            assert prefix[k] == n


def test_anchors_hold_every_window_once_and_agree_on_equal_windows():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    data[3000:4000] = data[500:1500]
    _, place, first, last = sd.anchors(data)
    assert np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)]).tolist() == list(range(len(data) - 399))
    offset = np.concatenate([p - np.arange(a, b + 1) for p, a, b in zip(place, first, last)])
    assert (offset[500:1101] == offset[3000:3601]).all()


def test_empty_table(no_docs):
    assert sd.repeats(no_docs).count() == 0
