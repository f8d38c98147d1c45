"""Toxicity by a weighted finite-state pattern grammar.

Tokens become classes: stem (of an insult, by a lexicon whose weights are
learned), threat verb, intention, target (second person), opener (copula or
intensifier), negation, reporting word, quote sign, colon, other. Contractions
are two tokens ("aren't" holds a negation, "you're" a target and a copula).
Five small transducers read a clause's classes:

* threat: an intention before a threat verb turns the verb into a threat;
* insult: a stem shortly after an opener or target, or with a target later in
  the clause, is an insult of full weight; a lone stem has a low arc weight;
* negation: an insult or threat within five words after a negation is negated;
* reported: after a reporting word (also across a colon), or between quotes;
* target: an insult or threat before or after a target is directed at somebody.

Their composition is one weighted transducer, built once, that rewrites the
clause into marked events. It may guess that a target follows (such paths end
well only if it does), so a clause's weight is that of its best path: the sum
over its events of the stem's weight times the factors on the way. Clauses end
at full stops, semicolons and line ends; only clauses with a stem or a threat
verb are read. A document's score is a logistic function of the weight of all
its clauses, of the heaviest clause, of the weight a word and of the number of
different stems matched, fitted with the lexicon on a bounded sample (SAMPLE
labelled rows, the first by a hash of the id) of rows that are not held out. A
stem is evidence by the number of different words that begin with it in texts
of either label, so few labelled texts teach a word family that they repeat.
Scoring reads whole texts.

Defined results: null text counts as empty and gets the score of a text without
matches. Repeated labels of a document count once (the larger). Without both
labels in the sample nothing is learned and every score is the smoothed share
of label 1 (0.5 without labels). Repeated rows are scored each; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.llm.common import hash_sample, held_out, modest_batches, small_side, text_or_empty, training_labels, written

SAMPLE = 20_000
LEAST_DOCS = 2
LEAST_ODDS = 1.5
#: Least evidence (G squared) of a stem: far above chance for some 100,000 candidates.
LEAST_EVIDENCE = 24.0
COVER = 3
STEM_LENGTHS = range(4, 13)

# Closed word classes of the grammar.
TARGETS = frozenset("you your yours yourself u ur ye du dich dir dein deine euch ihr tu te toi ton vous votre tú ti tus usted ustedes".split())
OPENERS = frozenset("are r is was were am be being re s m what such so very total totally complete utter absolute bloody damn "
                    "bist seid ist war so ein total es est êtes était quel quelle si très eres es son era qué muy tan".split())
NEGATIONS = frozenset("not no never neither nor none without hardly n't dont doesnt didnt isnt arent aint wasnt werent cant cannot wont wouldnt "
                      "nicht kein keine keinen nie niemals pas jamais aucun nunca jamás ningún".split())
REPORTING = frozenset("said says say saying wrote writes quoted quotes reported reports called calls claims claimed shouted yelled replied asked "
                      "sagte sagt schrieb nannte dit écrit appelé crié dijo dice escribió llamó gritó".split())
INTENTIONS = frozenset("will gonna ll shall going want wanna should must werde wirst wollen vais veux allons voy quiero vamos".split())
THREATS = frozenset("kill hurt destroy beat shoot stab burn strangle murder punch smash choke hang crush bury maim "
                    "töten umbringen schlagen verprügeln erschießen tuer frapper brûler étrangler matar golpear quemar estrangular".split())

WORD = re.compile(r"\w+?(?=n['’]t\b)|n['’]t\b|\w+|[\"“”«»:]")
CLAUSE_ENDS = ".!?;\n"
CLAUSE = re.compile(r"[^.!?;\n]+")
CLASSES = ("stem", "threat_verb", "intention", "target", "opener", "negation", "reporting", "quote", "colon", "other")
EVENTS = ("insult", "threat")

Arcs = dict[tuple[object, str], list[tuple[object, str, float]]]


@dataclass
class Transducer:
    """Weighted, maybe nondeterministic: (state, input class) -> choices of
    (state, output class, factor). Missing arcs copy the input and stay; an
    empty list is a dead end. The start state is 0; a path counts if it ends in
    a state outside ``unfinished``."""
    arcs: Arcs
    unfinished: frozenset = frozenset()

    def step(self, state: object, label: str) -> list[tuple[object, str, float]]:
        return self.arcs.get((state, label), [(state, label, 1.0)])


def compose(parts: list[Transducer], classes: tuple[str, ...] = CLASSES) -> Transducer:
    """One transducer over tuples of states that feeds each part's output to
    the next; only states reachable from the start are built."""
    start = (0,) * len(parts)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for label in classes:
            paths = [((), label, 1.0)]
            for part, s in zip(parts, state):
                paths = [((*after, nxt), out, factor * f) for after, given, factor in paths for nxt, out, f in part.step(s, given)]
            arcs[state, label] = paths
            for nxt, _, _ in paths:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
    names = {s: i for i, s in enumerate(sorted(seen))}
    assert names[start] == 0
    unfinished = frozenset(names[s] for s in seen if any(x in p.unfinished for p, x in zip(parts, s)))
    return Transducer({(names[s], c): [(names[t], o, f) for t, o, f in paths] for (s, c), paths in arcs.items()}, unfinished)


def threat_part() -> Transducer:
    return Transducer({(0, "intention"): [(1, "other", 1.0)], (1, "threat_verb"): [(0, "threat", 1.0)], (0, "threat_verb"): [(0, "other", 1.0)],
                       (1, "intention"): [(1, "other", 1.0)], (1, "colon"): [(0, "colon", 1.0)]})


def insult_part(lone: float, near: int = 4) -> Transducer:
    """States: words left in which a stem is opened; "ahead": a target must come."""
    ahead = near + 1
    arcs: Arcs = {(ahead, "stem"): [(ahead, "insult", 1.0)], (ahead, "target"): [(near, "target", 1.0)], (ahead, "colon"): [],
                  (ahead, "opener"): [(ahead, "other", 1.0)]}
    for left in range(near + 1):
        later = max(0, left - 1)
        arcs[left, "stem"] = [(later, "insult", 1.0)] if left else [(0, "insult", lone), (ahead, "insult", 1.0)]
        arcs[left, "opener"] = [(near, "other", 1.0)]
        arcs[left, "target"] = [(near, "target", 1.0)]
        arcs[left, "colon"] = [(0, "colon", 1.0)]
        for c in ("other", "negation", "reporting", "threat"):
            arcs[left, c] = [(later, c, 1.0)]
    return Transducer(arcs, frozenset([ahead]))


def negation_part(negated: float, reach: int = 5) -> Transducer:
    arcs: Arcs = {}
    for left in range(reach + 1):
        later = max(0, left - 1)
        arcs[left, "negation"] = [(reach, "other", 1.0)]
        arcs[left, "colon"] = [(0, "colon", 1.0)]
        for c in ("other", "target", "reporting"):
            arcs[left, c] = [(later, c, 1.0)]
        for e in EVENTS:
            arcs[left, e] = [(later, e, negated if left else 1.0)]
    return Transducer(arcs)


def reported_part(reported: float) -> Transducer:
    """States: 1 after a reporting word, 2 between quotes."""
    arcs: Arcs = {(0, "reporting"): [(1, "other", 1.0)], (0, "quote"): [(2, "other", 1.0)], (2, "quote"): [(0, "other", 1.0)],
                  (1, "quote"): [(1, "other", 1.0)]}
    arcs |= {(s, e): [(s, e, reported)] for s in (1, 2) for e in EVENTS}
    return Transducer(arcs)


def target_part(directed: float) -> Transducer:
    """States: 1 after a target, 2 where one must come."""
    arcs: Arcs = {(s, "target"): [(1, "other", 1.0)] for s in (0, 1, 2)}
    arcs |= {(0, "colon"): [(0, "other", 1.0)], (1, "colon"): [(0, "other", 1.0)], (2, "colon"): []}
    for e in EVENTS:
        arcs[0, e] = [(0, e, 1.0), (2, e, directed)]
        arcs[1, e], arcs[2, e] = [(1, e, directed)], [(2, e, directed)]
    return Transducer(arcs, frozenset([2]))


def grammar(lone: float = 0.4, negated: float = 0.35, reported: float = 0.5, directed: float = 1.5) -> Transducer:
    """The composed grammar. Outputs other than insult and threat weigh nothing."""
    return compose([threat_part(), insult_part(lone), negation_part(negated), reported_part(reported), target_part(directed)])


GRAMMAR = grammar()
THREAT_WEIGHT = 4.0


@dataclass
class Model:
    base: float
    stems: dict[str, float] | None = None
    weights: np.ndarray | None = None

    def __post_init__(self) -> None:
        alternatives = sorted(self.stems or {}, key=lambda s: (-len(s), s))
        self.lengths = sorted({len(s) for s in alternatives}, reverse=True)
        closed = sorted(THREATS, key=lambda s: (-len(s), s))
        self.finder = re.compile(r"\b(?:" + "|".join([*map(re.escape, alternatives), *(re.escape(w) + r"\b" for w in closed)]) + ")")

    def stem_of(self, word: str) -> str | None:
        """The longest stem that the word starts with."""
        for n in self.lengths:
            if n <= len(word) and word[:n] in self.stems:
                return word[:n]
        return None

    def label(self, word: str, matched: set[str]) -> tuple[str, float]:
        """A token's class and the weight of an event on it."""
        stem = self.stem_of(word)
        if stem is not None:
            matched.add(stem)
            return "stem", self.stems[stem]
        for name, words in (("threat_verb", THREATS), ("intention", INTENTIONS), ("target", TARGETS), ("negation", NEGATIONS),
                            ("opener", OPENERS), ("reporting", REPORTING)):
            if word in words:
                return name, THREAT_WEIGHT
        if word in ("n't", "n’t"):
            return "negation", 0.0
        return ("colon" if word == ":" else "other" if word[0].isalnum() or word[0] == "_" else "quote"), 0.0

    def clause_weight(self, clause: str, matched: set[str]) -> float:
        """Weight of the clause's best path that ends well."""
        best = {0: 0.0}
        for m in WORD.finditer(clause):
            label, weight = self.label(m.group(), matched)
            after: dict[object, float] = {}
            for state, total in best.items():
                for nxt, out, factor in GRAMMAR.arcs[state, label]:
                    w = total + weight * factor if out in EVENTS else total
                    if w > after.get(nxt, -1.0):
                        after[nxt] = w
            best = after
        return max(w for state, w in best.items() if state not in GRAMMAR.unfinished)

    def features(self, text: str) -> list[float]:
        """1, logs of the weight of all clauses, of the heaviest clause, of the
        weight a word and of the number of different stems."""
        low, total, most, matched, end = text.lower(), 0.0, 0.0, set(), -1
        for m in self.finder.finditer(low):
            if m.start() < end:
                continue
            start = max(low.rfind(c, 0, m.start()) for c in CLAUSE_ENDS) + 1
            clause = CLAUSE.match(low, start)
            end = clause.end()
            w = self.clause_weight(clause.group(), matched)
            total, most = total + w, max(most, w)
        words = low.count(" ") + low.count("\n") + 1
        return [1.0, math.log1p(total), math.log1p(most), math.log1p(100 * total / (words + 20)), math.log1p(len(matched))]

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.base
        z = float(np.dot(self.weights, self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


def stems_of(text: str) -> Counter:
    """Word beginnings, with the number of different words that have them."""
    return Counter(w[:n] for w in set(re.findall(r"\w+", text.lower())) for n in STEM_LENGTHS if n <= len(w))


def evidence(p: int, n: int, words_pos: int, words_neg: int) -> tuple[float, float]:
    """Log odds of a stem's rate a word, and G squared of its two counts."""
    odds = math.log((p + 0.5) / (words_pos + 1)) - math.log((n + 0.5) / (words_neg + 1))
    share = words_pos / (words_pos + words_neg)
    both = ((p, (p + n) * share), (n, (p + n) * (1 - share)))
    return odds, 2 * sum(k * math.log(k / e) for k, e in both if k)


def choose_stems(odds: dict[str, float], proof: dict[str, float], holders: dict[str, list[int]]) -> dict[str, float]:
    """Stems with their log odds, greedily: the next is the one that adds most
    to documents matched fewer than COVER times so far (of equals the best
    proven, then the longest); words that only a few copies share add little."""
    need, chosen = defaultdict(lambda: COVER), {}
    heap = set(odds)
    while heap:
        gain = {s: sum(need[d] > 0 for d in holders[s]) for s in heap}
        heap = {s for s, g in gain.items() if g >= LEAST_DOCS}  # gains only fall: the others can't return
        if not heap:
            break
        best = max(heap, key=lambda s: (gain[s] * proof[s], len(s), s))
        chosen[best] = odds[best]
        for d in holders[best]:
            need[d] -= 1
        # a stem that extends or shortens the chosen one matches the same words
        heap = {s for s in heap if not (s.startswith(best) or best.startswith(s))}
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> np.ndarray:
    """Newton steps for a logistic regression with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels_df: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon and weights from at most ``sample`` labelled documents."""
    modest_batches(docs.sparkSession)
    chosen = written(hash_sample(training_labels(labels_df, "toxic"), sample, "doc_id"), "toxic-sample-ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = written(texts.join(small_side(chosen), "doc_id").dropDuplicates(["doc_id"]), "toxic-sample")
    counts = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    base = (n_pos + 1.0) / (n_pos + n_neg + 2.0)
    if not n_pos or not n_neg:
        return Model(base)

    # equal texts are one piece of evidence
    texts_once = written(rows.dropDuplicates(["y", "text"]), "toxic-texts")

    def positive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(d, s, n) for d, t in zip(b["doc_id"], b["text"]) for s, n in stems_of(t).items()]
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "stem", "n"])

    held = texts_once.where("y = 1").mapInPandas(positive, "doc_id long, stem string, n long")
    pairs = written(held, "toxic-stems")
    frequent = pairs.groupBy("stem").agg(F.sum("n").alias("n"), F.count("*").alias("docs")).where(F.col("docs") >= LEAST_DOCS)
    pos = {r.stem: r.n for r in frequent.collect()}  # bounded by the sample

    def negative(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for b in batches:
            for t in b["text"]:
                seen.update({s: n for s, n in stems_of(t).items() if s in pos})
        if seen:
            yield pd.DataFrame({"stem": list(seen), "n": list(seen.values())})

    def word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "n": [len(set(re.findall(r"\w+", t.lower()))) for t in b["text"]]})

    neg = {r.stem: r.n for r in texts_once.where("y = 0").mapInPandas(negative, "stem string, n long")
           .groupBy("stem").agg(F.sum("n").alias("n")).collect()}
    words = {r.y: r.n for r in texts_once.mapInPandas(word_counts, "y int, n long").groupBy("y").agg(F.sum("n").alias("n")).collect()}
    found = {s: evidence(n, neg.get(s, 0), words.get(1, 0), words.get(0, 0)) for s, n in pos.items()}
    wanted = {s for s, (odds, proof) in found.items() if odds >= LEAST_ODDS and proof >= LEAST_EVIDENCE}

    def holders_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(d, s) for d, s in zip(b["doc_id"], b["stem"]) if s in wanted]
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "stem"])

    holders: dict[str, list[int]] = defaultdict(list)
    for r in pairs.mapInPandas(holders_of, "doc_id long, stem string").collect():
        holders[r.stem].append(r.doc_id)
    stems = choose_stems({s: found[s][0] for s in wanted}, {s: found[s][1] for s in wanted}, holders)
    draft = Model(base, stems)

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "x": [draft.features(t) for t in b["text"]]})

    got = rows.mapInPandas(featured, "y int, x array<double>").collect()
    return Model(base, stems, logistic(np.array([r.x for r in got]), np.array([r.y for r in got], dtype=float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    modest_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": [model.score(t) for t in b["text"]]})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return narrow.mapInPandas(run, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
