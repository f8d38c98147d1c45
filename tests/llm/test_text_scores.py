import math
import random
import zlib

import numpy as np

from churnscope.llm import quality_qda, toxicity_fst


def test_statistics_are_finite(edge_rows):
    for _, t in edge_rows:
        x = quality_qda.statistics(t)
        assert len(x) == len(quality_qda.FEATURES) and np.isfinite(x).all()


def test_quality_without_a_model_and_empty(edge_docs, edge_rows, small_labels, no_docs):
    got = quality_qda.score(edge_docs, small_labels).collect()
    assert len(got) == len(edge_rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
    assert all(r.score == 0.5 for r in quality_qda.score(edge_docs, small_labels.where("1 = 0")).collect())
    assert quality_qda.score(no_docs, small_labels).count() == 0


def test_discriminant_equals_plain_formula(monkeypatch):
    rng = np.random.default_rng(4)
    d = len(quality_qda.FEATURES)
    groups = {0: rng.normal(1, 2, (200, d)), 1: rng.normal(0, 1, (600, d))}
    monkeypatch.setattr(quality_qda, "sums_by_class", lambda rows: {y: (len(g), g.sum(0), g.T @ g) for y, g in groups.items()})
    model = quality_qda.fit(None, shrinkage=0.3, ridge=0.05)
    every = np.concatenate(list(groups.values()))
    z = {y: (g - every.mean(0)) / every.std(0) for y, g in groups.items()}
    pooled = sum(len(g) * np.cov(g.T, bias=True) for g in z.values()) / 800
    x = (every[:5] - every.mean(0)) / every.std(0)
    density = {}
    for y, g in z.items():
        cov = 0.7 * np.cov(g.T, bias=True) + 0.3 * pooled + 0.05 * np.eye(d)
        diff = x - g.mean(0)
        density[y] = np.log(len(g) / 800) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ni,ij,nj->n", diff, np.linalg.inv(cov), diff)
    assert np.allclose(model.scores(every[:5]), 1 / (1 + np.exp(-np.clip(density[1] - density[0], -60, 60))))


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_qda.score(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) >= 0.95


def toxic_corpus(spark):
    rng = random.Random(2)
    words = ["plain%d" % i for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                text.insert(rng.randrange(40), rng.choice(["blorkan", "blorkish", "snivvel"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out_accuracy(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity_fst.train(docs, labels)
    got = toxicity_fst.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert all(r.predicted == r.toxic for r in got) and len(got) > 100


def test_toxicity_edges(edge_docs, edge_rows, small_labels, no_docs):
    model = toxicity_fst.train(edge_docs, small_labels)
    got = toxicity_fst.score(edge_docs, model).collect()
    assert len(got) == len(edge_rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    none = toxicity_fst.train(edge_docs, small_labels.where("1 = 0"))
    assert {r.score for r in toxicity_fst.score(edge_docs, none).collect()} == {0.5}
    assert toxicity_fst.score(no_docs, none).count() == 0


def test_grammar_marks_clauses():
    model = toxicity_fst.Model(0.1, {"idiot": 4.0})
    weigh = lambda t: model.clause_weight(t, set())
    plain = weigh("what an idiot")
    assert math.isclose(plain, 4.0)
    assert weigh("you are an idiot") > plain
    assert weigh("he is not an idiot") < plain
    assert weigh("she said an idiot came") < plain
    assert weigh('the word "idiot" is short') < plain
    assert weigh("i will kill you") > 0 and weigh("they kill time") == 0


def weigher(stem="idiot", weight=4.0):
    model = toxicity_fst.Model(0.1, {stem: weight})
    return lambda t: model.clause_weight(t, set())


def test_isolated_words_weigh_less_than_clauses():
    weigh = weigher()
    lone, opened = weigh("the idiot came"), weigh("what an idiot")
    assert 0 < lone < opened < weigh("you are an idiot")
    assert weigh("idiot") == lone


def test_a_target_after_the_insult_directs_it():
    weigh = weigher()
    assert weigh("idiot, get lost, you") == weigh("you are an idiot") == weigh("what an idiot you are") > weigh("idiot")
    assert weigh("what an idiot: you came") == weigh("what an idiot")  # a colon parts clauses
    assert weigh("i will kill you") > weigh("i will kill time")


def test_contractions_negate():
    weigh = weigher()
    plain = weigh("you are an idiot")
    for t in ("you aren't an idiot", "you don't look like an idiot", "you arent an idiot", "you aren’t an idiot", "du bist kein idiot"):
        assert weigh(t) < 0.5 * plain, t
    assert weigh("you're an idiot") == plain
    assert weigh("i won't hurt you") < weigh("i'll hurt you") and weigh("i'll hurt you") > 0


def test_reported_speech_goes_across_a_colon():
    weigh = weigher()
    assert weigh("she wrote: you idiot") < weigh("you idiot") == weigh("note: you idiot")
    assert weigh('"you idiot" is what i heard') < weigh("you idiot")
    model = toxicity_fst.Model(0.1, {"idiot": 4.0})
    assert model.features("she wrote: you idiot")[1] < model.features("she left. you idiot")[1]


def test_few_labels_teach_a_repeated_word_family(spark):
    rng = random.Random(8)
    words = ["plain%d" % i for i in range(300)]
    docs, labels = [], []
    for i in range(240):
        text = [rng.choice(words) for _ in range(60)]
        if i % 40 == 0:
            text += ["grontal" + e for e in ("ish", "ung", "o", "er", "ists", "ment", "x")]
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 40 == 0)))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity_fst.train(docs, labels)
    assert any(s.startswith("gron") for s in model.stems)
    got = toxicity_fst.score(docs, model).join(labels, "doc_id").collect()
    assert all(r.predicted == r.toxic for r in got)


def test_toxicity_held_out_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity_fst.score(docs, toxicity_fst.train(docs, labels)).join(labels.where("toxic is not null"), "doc_id").where("held_out").collect()
    toxic, clean = ([r for r in got if r.toxic == y] for y in (1, 0))
    assert np.mean([r.predicted == 1 for r in toxic]) >= 0.9 and np.mean([r.predicted == 0 for r in clean]) >= 0.95


def test_composition_equals_running_the_parts_in_turn():
    rng = random.Random(9)
    choice = lambda: (rng.randrange(3), rng.choice("abc"), rng.choice([0.5, 1, 2]))
    parts = [toxicity_fst.Transducer({(s, c): [choice() for _ in range(rng.randrange(3))] for s in range(3) for c in "abc"}) for _ in range(3)]
    parts[0].unfinished = frozenset([2])
    whole = toxicity_fst.compose(parts, ("a", "b", "c"))
    for _ in range(30):
        symbols = [rng.choice("abc") for _ in range(4)]
        paths, plain = [(0, ())], [((0, 0, 0), ())]
        for c in symbols:
            paths = [(nxt, (*seen, (out, f))) for s, seen in paths for nxt, out, f in whole.step(s, c)]
            after = []
            for states, seen in plain:
                runs = [((), c, 1.0)]
                for part, s in zip(parts, states):
                    runs = [((*t, n), out, f * g) for t, given, f in runs for n, out, g in part.step(s, given)]
                after += [(t, (*seen, (out, f))) for t, out, f in runs]
            plain = after
        ends = [seen for s, seen in paths if s not in whole.unfinished]
        assert sorted(ends) == sorted(seen for t, seen in plain if t[0] != 2)
        assert len(paths) == len(plain)
