"""Secret scan: fixed patterns plus a linear-chain conditional random field.

Base spans are the matches of three fixed patterns. The CRF tags tokens as
secret begin, inside or outside; a token's features are its shape, length and
variety of characters, the shapes of its neighbours, a credential word shortly
before it, and features of the whole text. Its weights are fitted (full-batch
gradient of the conditional likelihood) on bounded samples of token runs, with
the value parts of base matches as labels. Each text with matches is learned
twice: as it is, and masked, with what the patterns go by taken away (the
credential word dropped or replaced, the access marker and the hex alphabet
altered; ``masked``), so that shape and context have to tell. So it adds spans that look and
Texts are decoded by
Viterbi over their whole length: stretches of plain words far from any token
with a digit, a credential word or an unusual length are outside whenever the
fitted weights prove it (``plain_is_outside``); otherwise every token goes
through Viterbi. A CRF span that overlaps a base span is not repeated.

Defined results: null text counts as empty; a text without spans has counts of
0, an empty span list and the SHA-256 of the empty string. Positions are code
points. Repeated rows are scanned each; an empty table gives no rows; extra
columns are ignored. Without any base match in the table there is nothing to
learn from and no span is added.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.llm.common import hash_sample, modest_batches, text_or_empty, written

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex")
#: The same for the JVM, to pick documents with matches for the sample.
ANY_BASE = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{12}"
            r"|AKIA[A-Z0-9]{14}|[0-9a-f]{16}")

#: Prior mean of each feature's weight for the label outside.
PRIOR_OUTSIDE = 0.7
#: Bounds of the fitting sample: documents with a base match, and any documents;
#: of their token runs (RUN tokens each) those with a tag and those without.
SAMPLE_WITH, SAMPLE_ANY = 600, 900
RUNS_WITH, RUNS_ANY = 3000, 9000
RUN = 48

TOKEN = re.compile(r"[\w+/\-]+|[^\w\s]")
CREDENTIAL = re.compile(r"password|passwd|secret|token|api_?key|credential|auth", re.I | re.A)
#: Where decoding can't be skipped: digits, signs, quotes, credential words, unusually long runs.
ACTIVE = re.compile(r"\d+|[:=\"'`]|password|passwd|secret|token|api_?key|credential|auth|[\w+/\-]{16,}", re.I | re.A)
AFTER = re.compile(r"\S*")
CHUNK = re.compile(r"\s*\S+")

O, B, I = 0, 1, 2
SHAPES = ["word", "capital", "upper", "digits", "hex", "upper_digits", "alnum", "joined", "credential", "sign", "quote", "other"]
PLAIN_SHAPES = (0, 1, 2, 7, 11)
LENGTHS = (3, 7, 11, 15, 19, 31)
N_S, N_L = len(SHAPES), len(LENGTHS) + 1
# feature groups: shape x length, previous, one before, next, near a credential x shape, variety x length, known prefix, file
_SIZES = [N_S * N_L, N_S + 1, N_S + 1, N_S + 1, 2 * N_S, 4 * N_L, 2, 4, 3]
_START = np.concatenate([[0], np.cumsum(_SIZES)])
N_FEATURES = int(_START[-1])


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Base matches by kind, leftmost and non-overlapping within a kind."""
    return {"assign": [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST],
            "access": [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST],
            "hex": [m.span() for m in HEX.finditer(text)]}


def value_spans(text: str) -> list[tuple[int, int]]:
    """The value parts of base matches: what the CRF learns to tag."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    return out + [s for k in ("access", "hex") for s in base_spans(text)[k]]


def masked(text: str) -> tuple[str, list[tuple[int, int]]]:
    """The text without what the base patterns go by, and its values' spans:
    a credential word is dropped or replaced by the word before it, an access
    marker by other letters, and the letters of hex values by letters of the
    whole alphabet; long runs of digits are grouped by dashes. Choices follow a hash of the text."""
    rng = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    upper = "BCDEFGHJKLMNPQRSTUVWXYZ"
    found = [(m.start(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(s, s, e) for k in ("access", "hex") for s, e in base_spans(text)[k]]
    out, spans, at, n = [], [], 0, 0
    for start, value, end in sorted(found):
        if start < at:
            continue
        lead = text[start:value]
        if lead:
            word = CREDENTIAL.match(lead).end()
            before = re.findall(r"[A-Za-z]+", text[max(0, start - 40):start])
            lead = (before[-1] if before and rng.random() < 0.5 and not CREDENTIAL.search(before[-1]) else "") + lead[word:]
        secret = text[value:end]
        if secret.startswith("AKIA"):
            secret = "".join(rng.choice(upper) for _ in range(4)) + secret[4:]
        elif HEX.search(secret):
            wide = upper if rng.random() < 0.5 else upper + upper.lower()
            secret = secret.translate({ord(c): rng.choice(wide) for c in "abcdef"})
        if HEX.search(secret):  # digits alone
            secret = "-".join(secret[i:i + 4] for i in range(0, len(secret), 4))
        pieces = [text[at:start], lead]
        n += sum(map(len, pieces))
        spans.append((n, n + len(secret)))
        n += len(secret)
        out += [*pieces, secret]
        at = end
    return "".join([*out, text[at:]]), spans


def token_features(token: str) -> tuple[int, int, int, int, bool]:
    """shape, length bucket, variety bucket, known prefix, separator-or-quote."""
    n = len(token)
    length = sum(n > x for x in LENGTHS)
    variety = min(3, (4 * len(set(token))) // (n + 1))
    if not (token[0].isalnum() or token[0] in "_+/-"):
        return (9 if token in "=:" else 10 if token in "\"'`" else 11), length, variety, 0, token in "=:\"'`"
    digits = any(c.isdigit() for c in token)
    if CREDENTIAL.search(token):
        shape = 8
    elif not digits:
        shape = 7 if not token.isalpha() else 2 if token.isupper() and n > 1 else 1 if token[0].isupper() else 0
    elif token.isdigit():
        shape = 3
    elif not token.isalnum():
        shape = 7 if n < 8 else 6
    elif re.fullmatch(r"[0-9a-f]+", token):
        shape = 4
    else:
        shape = 5 if token.isupper() else 6
    return shape, length, variety, int(n > 15 and token[:2] in ("AK", "sk", "gh", "ey")), False


def file_features(text: str) -> tuple[int, int]:
    """Share of digits in the whole text and its length, in buckets."""
    digits = sum(map(text.count, "0123456789")) / (len(text) + 1)
    return sum(digits > x for x in (0.01, 0.05, 0.2)), sum(len(text) > x for x in (500, 5000))


def segments(text: str, whole: bool = False) -> list[list[tuple[int, int, bool]]]:
    """Token runs (start, end, decoded) around active places: two chunks of
    text without white space on either side are decoded, a third gives context
    only. ``whole``: all tokens as one run."""
    if whole:
        run = [(m.start(), m.end(), True) for m in TOKEN.finditer(text)]
        return [run] if run else []
    cores: list[list[int]] = []  # start and end of the chunks with active places
    for m in ACTIVE.finditer(text):
        if cores and m.start() < cores[-1][1]:
            continue
        s = m.start()
        while s > 0 and not text[s - 1].isspace():
            s -= 1
        cores.append([s, AFTER.match(text, m.end()).end()])
    windows: list[list[int]] = []  # context start, decode start, decode end, context end
    for s, e in cores:
        bounds, at = [s], s
        for _ in range(3):
            while at > 0 and text[at - 1].isspace():
                at -= 1
            while at > 0 and not text[at - 1].isspace():
                at -= 1
            bounds.append(at)
        ends, at = [e], e
        for _ in range(3):
            at = m.end() if (m := CHUNK.match(text, at)) else at
            ends.append(at)
        if windows and bounds[3] <= windows[-1][3]:
            windows[-1][2:] = ends[2:]
        else:
            windows.append([bounds[3], bounds[2], ends[2], ends[3]])
    return [[(m.start(), m.end(), d0 <= m.start() < d1) for m in TOKEN.finditer(text, c0, c1)] for c0, d0, d1, c1 in windows]


def feature_rows(text: str, runs: list[list[tuple[int, int, bool]]], cache: dict) -> list[tuple[list[tuple[int, int]], np.ndarray]]:
    """For each run: the decoded tokens' spans and their feature indices."""
    out, (f_digit, f_len) = [], file_features(text)
    s1, s2, s3, s4, s5, s6, s7, s8 = map(int, _START[1:9])
    last7 = s7 + f_digit, s8 + f_len
    for run in runs:
        feats = []
        for s, e, _ in run:
            t = text[s:e]
            if (f := cache.get(t)) is None:
                if len(cache) > 200_000:
                    cache.clear()
                f = cache[t] = token_features(t)
            feats.append(f)
        spans, rows, near = [], [], 0
        for i, (s, e, decoded) in enumerate(run):
            shape, length, variety, prefix, _sep = feats[i]
            if decoded:
                spans.append((s, e))
                rows.append((shape * N_L + length, s1 + (feats[i - 1][0] if i else N_S),
                             s2 + (feats[i - 2][0] if i > 1 else N_S), s3 + (feats[i + 1][0] if i + 1 < len(run) else N_S),
                             s4 + shape + (N_S if near else 0), s5 + variety * N_L + length, s6 + prefix, *last7))
            near = 4 if shape == 8 else max(0, near - 1)
        if spans:
            out.append((spans, np.array(rows, dtype=np.int32)))
    return out


@dataclass
class Crf:
    """Emission weights by feature and label, transitions between labels."""
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, rows: np.ndarray) -> np.ndarray:
        return self.weights[rows].sum(axis=1)

    def slack(self) -> float:
        """The most that transitions can gain by turning one outside label into
        another, whatever its neighbours are."""
        t = self.transitions
        around = t[:, :, None] + t[None, :, :]  # before, label, after
        return float((around[:, 1:, :] - around[:, :1, :]).max())

    def plain_is_outside(self) -> bool:
        """Whether a plain token among plain neighbours is outside in every
        best path: its least lead exceeds what transitions could gain."""
        w = self.weights
        lead = w[:, O] - w[:, 1:].max(axis=1)
        cut = [lead[a:b] for a, b in zip(_START, _START[1:])]
        own = min(cut[0].reshape(N_S, N_L)[s, n] + min(cut[4][s], cut[4][N_S + s]) + min(cut[5].reshape(4, N_L)[:, n])
                  for s in PLAIN_SHAPES for n in range(4))
        beside = [*PLAIN_SHAPES, N_S]
        return own + sum(min(cut[k][beside]) for k in (1, 2, 3)) + cut[6][0] + min(cut[7]) + min(cut[8]) > max(0.0, self.slack())

    def decode(self, emissions: np.ndarray) -> list[int]:
        """Viterbi."""
        t = self.transitions.tolist()
        best, back = emissions[0].tolist(), []
        for e in emissions[1:].tolist():
            step, arrow = [], []
            for y in range(3):
                a, b, c = best[0] + t[0][y], best[1] + t[1][y], best[2] + t[2][y]
                k = (0 if a >= c else 2) if a >= b else (1 if b >= c else 2)
                arrow.append(k)
                step.append((a, b, c)[k] + e[y])
            best = step
            back.append(arrow)
        y = max(range(3), key=best.__getitem__)
        path = [y]
        for arrow in reversed(back):
            y = arrow[y]
            path.append(y)
        return path[::-1]


def tagged_runs(text: str, values: list[tuple[int, int]], cache: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature rows and tags of the text's decoded runs, cut at RUN tokens."""
    for spans, rows in feature_rows(text, segments(text), cache):
        tags = np.zeros(len(spans), dtype=np.int64)
        for a, b in values:
            inside = [i for i, (s, e) in enumerate(spans) if s < b and e > a]
            for i in inside:
                tags[i] = B if i == inside[0] else I
        for k in range(0, len(spans), RUN):
            yield rows[k:k + RUN], tags[k:k + RUN]


def learned_runs(text: str, cache: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of the text and, if it has values, of its masked form."""
    values = value_spans(text)
    yield from tagged_runs(text, values, cache)
    if values:
        yield from tagged_runs(*masked(text), cache)


def fit(texts: list[str], **how) -> Crf | None:
    """Weights from a list of texts (see ``fit_runs``)."""
    cache: dict = {}
    return fit_runs([r for t in texts for r in learned_runs(t, cache)], **how)


def fit_runs(tagged: list[tuple[np.ndarray, np.ndarray]], steps: int = 80, rate: float = 0.2, decay: float = 5e-4) -> Crf | None:
    """Weights from a bounded list of runs by full-batch gradient (Adam) of
    the conditional likelihood. The prior mean favours outside, so features
    never seen don't tag."""
    runs, gold = [r for r, _ in tagged], [g for _, g in tagged]
    if not any(g.any() for g in gold):
        return None
    n, longest = len(runs), max(map(len, runs))
    x = np.full((n, longest, len(_SIZES)), N_FEATURES, dtype=np.int64)  # the last weight row is fixed at 0
    y, real = np.zeros((n, longest), dtype=np.int64), np.zeros((n, longest), dtype=bool)
    for i, (r, g) in enumerate(zip(runs, gold)):
        x[i, :len(r)], y[i, :len(r)], real[i, :len(r)] = r, g, True
    theta = np.zeros((N_FEATURES + 1 + 3, 3))
    theta[:N_FEATURES, O] = PRIOR_OUTSIDE
    prior = theta.copy()
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    eye, total = np.eye(3), real.sum()
    pair = real[:, 1:]
    gold_pairs = np.einsum("nta,ntb->ab", eye[y[:, :-1]] * pair[..., None], eye[y[:, 1:]])
    flat = x.reshape(-1, len(_SIZES))
    for step in range(1, steps + 1):
        w, t = theta[:N_FEATURES + 1], theta[N_FEATURES + 1:]
        e = w[x].sum(axis=2)
        alpha, beta = np.zeros((n, longest, 3)), np.zeros((n, longest, 3))
        alpha[:, 0] = e[:, 0]
        for k in range(1, longest):
            a = np.logaddexp.reduce(alpha[:, k - 1, :, None] + t, axis=1) + e[:, k]
            alpha[:, k] = np.where(real[:, k, None], a, alpha[:, k - 1])
        for k in range(longest - 2, -1, -1):
            b = np.logaddexp.reduce(t + (e[:, k + 1] + beta[:, k + 1])[:, None, :], axis=2)
            beta[:, k] = np.where(real[:, k + 1, None], b, 0.0)
        z = np.logaddexp.reduce(alpha[:, -1], axis=1)
        p = np.exp(np.where(real[..., None], alpha + beta - z[:, None, None], -np.inf))
        joint = np.exp(np.where(pair[..., None, None], alpha[:, :-1, :, None] + t
                                + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None], -np.inf))
        grad = np.zeros_like(theta)
        diff = ((eye[y] * real[..., None]) - p).reshape(-1, 3)
        for label in range(3):
            grad[:N_FEATURES + 1, label] = np.bincount(flat.ravel(), np.repeat(diff[:, label], len(_SIZES)), N_FEATURES + 1)
        grad[N_FEATURES + 1:] = gold_pairs - joint.sum(axis=(0, 1))
        grad = grad / total - decay * (theta - prior)
        grad[N_FEATURES] = 0.0
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Crf(theta[:N_FEATURES].copy(), theta[N_FEATURES + 1:].copy())


def crf_spans(text: str, crf: Crf, skip_plain: bool, cache: dict) -> list[tuple[int, int]]:
    """Spans that the CRF tags in the whole text."""
    out, slack = [], max(0.0, crf.slack())
    for spans, rows in feature_rows(text, segments(text, whole=not skip_plain), cache):
        e = crf.emissions(rows)
        sure = e[:, O] - e[:, 1:].max(axis=1) > slack  # outside in every best path
        if sure.all():
            continue
        start = None
        for (s, stop), y in zip(spans, crf.decode(e)):
            if y == B or (y == I and start is None):
                if start is not None:
                    out.append((start, end))
                start, end = s, stop
            elif y == I:
                end = stop
            elif start is not None:
                out.append((start, end))
                start = None
        if start is not None:
            out.append((start, end))
    return out


def scan_text(text: str, crf: Crf | None, skip_plain: bool, cache: dict) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[int, int]]]:
    """Base spans by kind, and the CRF's spans that overlap none of them."""
    base = base_spans(text)
    if crf is None:
        return base, []
    taken, added, k = sorted(s for v in base.values() for s in v), [], 0
    merged: list[list[int]] = []
    for s, e in taken:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in sorted(crf_spans(text, crf, skip_plain, cache)):
        while k < len(merged) and merged[k][1] <= s:
            k += 1
        if k == len(merged) or merged[k][0] >= e:
            added.append((s, e))
    return base, added


def spans_text(spans: dict[str, list[tuple[int, int]]]) -> str:
    """kind:start:end, by start, then kind in the given order, comma-joined."""
    order = {k: i for i, k in enumerate(spans)}
    found = sorted((s, order[k], e, k) for k, v in spans.items() for s, e in v)
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in found)


def train(docs: DataFrame, with_match: int = SAMPLE_WITH, any_doc: int = SAMPLE_ANY) -> Crf | None:
    """Fit on at most ``with_match`` documents with a base match and
    ``any_doc`` of all, the first by a hash of id and text."""
    modest_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    some = hash_sample(narrow.where(F.col("text").rlike(ANY_BASE)), with_match, "doc_id", "text")
    plain = hash_sample(narrow, any_doc, "doc_id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for b in batches:
            for text in b["text"]:
                found = [(r.astype(np.int32).tobytes(), g.astype(np.int8).tobytes(), bool(g.any())) for r, g in learned_runs(text, cache)]
                if found:
                    yield pd.DataFrame(found, columns=["x", "y", "tagged"])

    # texts stay in the tasks; the driver gets bounded numbers of short runs
    runs = written(some.union(plain).select("text").mapInPandas(run, "x binary, y binary, tagged boolean"), "secret-runs")
    got = [r for mark, n in ((True, RUNS_WITH), (False, RUNS_ANY)) for r in hash_sample(runs.where(F.col("tagged") == mark), n, "x", "y").collect()]
    return fit_runs([(np.frombuffer(r.x, np.int32).reshape(len(r.y), -1), np.frombuffer(r.y, np.int8).astype(np.int64)) for r in got])


def scan(docs: DataFrame, crf: Crf | None, keep: list[str] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document,
    and the columns named in ``keep`` unchanged."""
    modest_batches(docs.sparkSession)
    skip_plain = crf is not None and crf.plain_is_outside()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for b in batches:
            rows = []
            for text in b["_text"]:
                base, added = scan_text(text, crf, skip_plain, cache)
                digest = hashlib.sha256(spans_text(base).encode()).hexdigest()
                rows.append((*(len(base[k]) for k in KINDS), digest, spans_text(base | {"crf": added})))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            for c in ("doc_id", *(keep or [])):
                out[c] = b[c].to_numpy()
            yield out

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(keep or []), text_or_empty().alias("_text"))
    kept = "".join(f", {f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields if f.name in (keep or []))
    return narrow.mapInPandas(run, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
                                   f"doc_id long{kept}").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", *(keep or []))


def redact(docs: DataFrame, crf: Crf | None, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span found in ``text`` replaced by ``mask``; texts
    without spans, null texts and all other columns stay as they are."""
    modest_batches(docs.sparkSession)
    skip_plain = crf is not None and crf.plain_is_outside()

    def clean(text: str | None, cache: dict) -> str | None:
        if not text:
            return text
        base, added = scan_text(text, crf, skip_plain, cache)
        out, at = [], 0
        for s, e in sorted([x for v in base.values() for x in v] + added):
            if s >= at:
                out += [text[at:s], mask]
            at = max(at, e)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for b in batches:
            b["text"] = pd.Series([clean(t, cache) for t in b["text"]], index=b.index, dtype=object)
            yield b

    return docs.mapInPandas(run, docs.schema)
