import math
import random

import numpy as np
import pytest

from churnscope.llm import sentencepiece_viterbi as sv


def toy():
    rng = random.Random(1)
    pieces = {sv.SPACE: -3.0, sv.SPACE * 2: -5.0}
    for _ in range(60):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 5)))
        pieces.setdefault(rng.choice(["", sv.SPACE]) + p, -float(rng.randrange(1, 30)))
    items = [(300 + i, p, s) for i, (p, s) in enumerate(pieces.items())]
    return items, list(range(256))


def best_score(text, scores, unknown):
    s = sv.SPACE + text.replace(" ", sv.SPACE)
    best = [0.0] + [-math.inf] * len(s)
    for j in range(1, len(s) + 1):
        for i in range(j):
            if s[i:j] in scores:
                best[j] = max(best[j], best[i] + scores[s[i:j]])
        if s[j - 1] not in scores:
            best[j] = max(best[j], best[j - 1] + unknown)
    return best[-1]


def test_viterbi_against_all_segmentations():
    items, byte_ids = toy()
    enc, scores = sv.Encoder(items, byte_ids), {p: s for _, p, s in items}
    by_id = {i: (p, s) for i, p, s in items}
    rng = random.Random(2)
    for _ in range(500):
        t = "".join(rng.choice("aabbcc  dé") for _ in range(rng.randrange(1, 25)))
        ids = enc.encode(t)
        total = sum(by_id[i][1] for i in ids if i in by_id) + enc.unknown * sum(c not in scores and c != " " for c in t)
        assert math.isclose(total, best_score(t, scores, enc.unknown))


def test_round_trip_with_the_public_model(spark, edge_docs, edge_rows, no_docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = sv.default_model_path()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    encoded = sv.encode(edge_docs)
    for r in encoded.collect():
        assert model.decode(list(r.ids)) == r.text
    got = sv.decode_column(encoded).collect()
    assert len(got) == len(edge_rows) and all(r.round_trip for r in got)
    assert {r.n_pieces for r in got if r.doc_id in (1, 2)} == {0}
    assert sv.decode_column(sv.encode(no_docs)).count() == 0
    sign = spark.createDataFrame([(1, "a▁b")], "doc_id long, text string")
    assert not sv.decode_column(sv.encode(sign)).first().round_trip


def test_cache_changes_nothing():
    items, byte_ids = toy()
    enc = sv.Encoder(items, byte_ids)
    t = "abc cab abc  bca abc"
    assert enc.encode(t) == enc.encode(t) == sv.Encoder(items, byte_ids).encode(t)
    assert np.array(enc.encode("")).size == 0
