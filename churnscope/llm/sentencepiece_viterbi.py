"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over all pieces reads a text once; at each position
the output links name every piece that ends there, longest first, and each
relaxes the best score of the position (Viterbi, highest sum of piece scores).
A character that is no piece falls back to its UTF-8 bytes' pieces. The
vocabulary is a model file whose path is a parameter; nothing is trained.

No piece spans the border before a run of space signs, so the best path of a
text is the best paths of its units (space signs and what follows up to the
next). Units that were seen before come from a bounded cache per worker.

Follows the model's own text rules: a space sign is put in front of a text that
isn't empty, and every space becomes a space sign; nothing else is normalised.
Ties: the longer last piece wins. Defined results: null and empty texts have no
pieces. Decoding gives the text back exactly, but for texts that hold the space
sign U+2581 itself, which decodes as a space (``round_trip`` is false there).
Repeated rows are encoded each; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.llm.common import modest_batches, text_or_empty

SPACE = "▁"
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
CACHE = 500_000
#: How far an unknown character scores below the least piece.
UNKNOWN_PENALTY = 10.0


def default_model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str) -> tuple[list[tuple[int, str, float]], list[int], list[bytes]]:
    """(id, piece, score) of the ordinary pieces, the ids of the 256 byte
    pieces, and the bytes of every id (empty for control pieces)."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, raw = [], [0] * 256, []
    for i in range(m.get_piece_size()):
        p = m.id_to_piece(i)
        if m.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            raw.append(bytes([int(p[3:5], 16)]))
        elif m.is_control(i) or m.is_unknown(i):
            raw.append(b"")
        else:
            pieces.append((i, p, m.get_score(i)))
            raw.append(p.replace(SPACE, " ").encode())
    if any(SPACE in p[1:] and p.strip(SPACE) for _, p, _ in pieces):
        raise ValueError("a piece holds a space sign after other characters: units can't be encoded apart")
    return pieces, byte_ids, raw


class Encoder:
    """The automaton: per node its next nodes by character, its failure link,
    the piece that ends there, and the nearest node down the failure links
    where a piece ends (output link)."""

    def __init__(self, pieces: list[tuple[int, str, float]], byte_ids: list[int]) -> None:
        self.byte_ids = byte_ids
        self.unknown = min((s for _, _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.next: list[dict[str, int]] = [{}]
        self.fail, self.link = [0], [0]
        self.piece, self.length, self.score = [-1], [0], [0.0]
        for i, p, s in pieces:
            node = 0
            for ch in p:
                if ch not in self.next[node]:
                    self.next[node][ch] = len(self.next)
                    self.next.append({})
                    self.fail.append(0)
                    self.link.append(0)
                    self.piece.append(-1)
                    self.length.append(0)
                    self.score.append(0.0)
                node = self.next[node][ch]
            self.piece[node], self.length[node], self.score[node] = i, len(p), s
        todo = deque(self.next[0].values())
        while todo:
            node = todo.popleft()
            for ch, child in self.next[node].items():
                f = self.fail[node]
                while f and ch not in self.next[f]:
                    f = self.fail[f]
                f = self.next[f].get(ch, 0)
                self.fail[child] = f
                self.link[child] = f if self.piece[f] >= 0 else self.link[f]
                todo.append(child)
        self.cache: dict[str, tuple[int, ...]] = {}

    def viterbi(self, unit: str) -> tuple[int, ...]:
        """Ids of the best path of one unit."""
        nxt, fail, link, piece, length, score = self.next, self.fail, self.link, self.piece, self.length, self.score
        best, back, node = [0.0], [(0, -1)], 0
        for end, ch in enumerate(unit, 1):
            while node and ch not in nxt[node]:
                node = fail[node]
            node = nxt[node].get(ch, 0)
            out = node if piece[node] >= 0 else link[node]
            top, arrow, known = float("-inf"), (0, -1), False
            while out:
                n = length[out]
                v = best[end - n] + score[out]
                if v > top:
                    top, arrow = v, (n, piece[out])
                known = n == 1
                out = link[out]
            if not known and best[end - 1] + self.unknown > top:
                top, arrow = best[end - 1] + self.unknown, (1, -1)
            best.append(top)
            back.append(arrow)
        path, end = [], len(unit)
        while end:
            n, p = back[end]
            path.append([p] if p >= 0 else [self.byte_ids[b] for b in unit[end - 1].encode("utf-8", "replace")])
            end -= n
        return tuple(chain.from_iterable(reversed(path)))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        cache, parts = self.cache, []
        for u in UNIT.findall(SPACE + text.replace(" ", SPACE)):
            ids = cache.get(u)
            if ids is None:
                ids = self.viterbi(u)
                if len(u) <= 64:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[u] = ids
            parts.append(ids)
        return list(chain.from_iterable(parts))


_SHARED: dict[str, Encoder] = {}


def shared_encoder(name: str, pieces: list[tuple[int, str, float]], byte_ids: list[int]) -> Encoder:
    """One encoder per Python worker and model: tasks that follow in the same
    worker find the automaton built and the cache warm."""
    if name not in _SHARED:
        _SHARED.clear()
        _SHARED[name] = Encoder(pieces, byte_ids)
    return _SHARED[name]


def decode(ids: list[int], raw: list[bytes]) -> str:
    """The text of ids: their bytes, without the space put in front."""
    data = b"".join(map(raw.__getitem__, ids))
    return data[1:].decode("utf-8", "replace") if data[:1] == b" " else data.decode("utf-8", "replace")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text (null as empty), ids of every document."""
    pieces, byte_ids, _ = read_model(path or default_model_path())
    modest_batches(docs.sparkSession, 500)

    name = hashlib.md5(repr((pieces, byte_ids)).encode()).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = shared_encoder(name, pieces, byte_ids)
        for b in batches:
            yield b.assign(ids=[np.array(encoder.encode(t), dtype=np.int32) for t in b["text"]])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return narrow.mapInPandas(run, "doc_id long, text string, ids array<int>")


def decode_column(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, text, ids) with n_pieces, n_byte_pieces, ids_sha256
    (of the ids as little-endian 32-bit numbers), round_trip."""
    _, byte_ids, raw = read_model(path or default_model_path())
    is_byte = np.zeros(len(raw), bool)
    is_byte[byte_ids] = True

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = [np.asarray(i, dtype="<i4") for i in b["ids"]]
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "n_pieces": [len(i) for i in ids], "n_byte_pieces": [int(is_byte[i].sum()) for i in ids],
                "ids_sha256": [hashlib.sha256(i.tobytes()).hexdigest() for i in ids],
                "round_trip": [decode(i.tolist(), raw) == t for i, t in zip(ids, b["text"])]})

    return encoded.mapInPandas(run, "doc_id long, n_pieces long, n_byte_pieces long, ids_sha256 string, round_trip boolean")
