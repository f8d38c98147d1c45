"""Repeated-substring removal over a collection of documents.

Every byte covered by a LENGTH-byte string that starts anywhere else is
removed. The collection's suffixes are ordered column by column: each round
adds one symbol in front of every document's current suffix, and the order and
the common prefixes of neighbours follow from those of the round before (a
stable sort by the new symbol; range minima of the old prefixes plus one). The
symbols in suffix order are the round's column of the collection's
Burrows-Wheeler transform. Neighbours with a common prefix of LENGTH or more
are repeats.

Only suffixes that could repeat enter that construction, and only against
those they could equal. Each LENGTH-byte window is anchored at the smallest
hash among its KMER-byte strings (the last of equals); equal windows have equal
anchors at equal offsets. Windows whose anchor string occurs once in the
collection are done. For the others the stretch of text that holds an anchor's
windows is a segment; equal segments are one document of the collection (all
their windows repeat), and the different segments of an anchor are aligned at
it, so that round d compares the windows that start d bytes before it. Segments
are dealt by anchor to shards of bounded size, which stand in for the external
files that the construction reads in sequence. An anchor with more than
HOT_SEGMENTS different segments is not brought into one task: its windows are
counted by 128-bit digest with map-side partial sums.

Whole texts that occur several times are processed once. Memory per task is
bounded by one shard or one text. Defined results: null text is empty; texts
under LENGTH bytes lose nothing; repeated rows repeat each other's text; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.llm.common import modest_batches, small_side, text_or_empty, written

LENGTH = 400
KMER = 128
SHARD_SEGMENTS = 8192
HOT_SEGMENTS = 50_000

_U = np.uint64
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 2 ** 64)
_BLOCK = 1 << 19
_MASK = _U((1 << 20) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    f = np.full(n, base, np.uint64)
    f[0] = 1
    return np.multiply.accumulate(f)


_UP, _DOWN = _powers(_BASE, _BLOCK + 4096), _powers(_INVERSE, _BLOCK + 4096)


def _kmer_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes at each position of one block."""
    n = len(data)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + _U(1)) * _UP[:n], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * _DOWN[:n - k + 1]
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(30))


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = len(v)
    pad = np.full(-n % w, np.iinfo(np.uint64).max, np.uint64)
    rows = np.concatenate([v, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def anchors(data: np.ndarray, length: int = LENGTH, k: int = KMER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, anchor, first window, last window) of the anchors of one text's
    windows, block by block; together they hold every window once."""
    out = []
    for at in range(0, max(0, len(data) - length + 1), _BLOCK):
        block = data[at:at + _BLOCK + length - 1]
        h = _kmer_hashes(block, k)
        order = (h & ~_MASK) | (_MASK - np.arange(len(h), dtype=np.uint64))
        least = _sliding_min(order, length - k + 1)
        place = (_MASK - (least & _MASK)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(place) - 1]])
        place = place[first]
        out.append((h[place].view(np.int64), place + at, first + at, last + at))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    return tuple(np.concatenate(x) for x in zip(*out))


def column_rounds(columns: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The column-wise construction over documents aligned in ``columns`` (one
    row per document, symbols 0-255, -1 where a document has none), from the
    last column to the first. ``group`` is sorted; documents of different
    groups are never compared. Yields, for each column inserted, its number,
    the suffix order and the common prefix of each suffix with the one before."""
    m, width = columns.shape
    by_column = np.ascontiguousarray(columns.T).astype(np.int64)  # the columns, one after the other
    order, prefix = np.arange(m), np.zeros(m, np.int64)
    key = group.astype(np.int64) * 257
    for c in range(width - 1, -1, -1):
        symbol = by_column[c][order]  # this round's column of the transform
        ranked = key[order] + symbol + 1
        step = np.argsort(ranked, kind="stable")  # new position -> old position
        ranked = ranked[step]
        joined = np.flatnonzero((ranked[1:] == ranked[:-1]) & (symbol[step[1:]] >= 0)) + 1
        new = np.zeros(m, np.int64)
        if len(joined):
            span = np.empty(2 * len(joined), np.int64)
            span[0::2], span[1::2] = step[joined - 1] + 1, step[joined] + 1
            # the last bound may be one past the end
            new[joined] = 1 + np.minimum.reduceat(np.append(prefix, 0), span)[0::2]
        order, prefix = order[step], new
        yield c, order, prefix


def repeated_windows(segments: list[bytes], keys: np.ndarray, before: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Per segment (rows) and distance d before its anchor (columns): whether
    the window that starts there equals another segment's window of the same
    key. ``before`` is the anchor's offset in its segment."""
    rank = np.argsort(keys, kind="stable")
    _, group = np.unique(keys[rank], return_inverse=True)
    left = int(before.max())
    right = max(len(s) - int(b) for s, b in zip(segments, before))
    columns = np.full((len(segments), left + right), -1, np.int16)
    for row, i in enumerate(rank):
        s, at = segments[i], left - int(before[i])
        columns[row, at:at + len(s)] = np.frombuffer(s, np.uint8)
    found = np.zeros((len(segments), left + 1), bool)
    for c, order, prefix in column_rounds(columns, group):
        if c > left:
            continue
        hit = np.flatnonzero(prefix >= length)
        if len(hit):
            found[rank[order[hit]], left - c] = True
            found[rank[order[hit - 1]], left - c] = True
    return found


def _ranges(flags: np.ndarray) -> list[list[int]]:
    """[first, last] of the runs of True."""
    at = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [[int(a), int(b) - 1] for a, b in zip(at[0::2], at[1::2])]


def merge(spans: list[list[int]]) -> list[list[int]]:
    """Maximal runs of the byte ranges [start, end)."""
    out: list[list[int]] = []
    for s, e in sorted(map(list, spans)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def cut(data: bytes, spans: list[list[int]]) -> bytes:
    """``data`` without the given runs."""
    out, at = [], 0
    for s, e in spans:
        out.append(data[at:s])
        at = e
    return b"".join([*out, data[at:]])


def _anchor_table(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tids, parts = [], []
            for tid, text in zip(b["tid"], b["text"]):
                got = anchors(np.frombuffer(text.encode("utf-8"), np.uint8), length)
                tids += [tid] * len(got[0])
                parts.append(got)
            if tids:
                key, place, first, last = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({"tid": tids, "key": key, "place": place, "first": first, "last": last})

    return texts.mapInPandas(run, "tid binary, key long, place long, first long, last long")


def _segment_table(texts: DataFrame, length: int) -> DataFrame:
    """Segments of texts (tid, text, at: array of key, place, first, last)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for tid, text, at in zip(b["tid"], b["text"], b["at"]):
                data = text.encode("utf-8")
                for a in at:
                    s, before = data[a["first"]:a["last"] + length], a["place"] - a["first"]
                    sid = hashlib.md5(b"%d:%d:" % (a["key"], before) + s).digest()
                    rows.append((tid, a["first"], a["key"], sid, before, s))
                    if len(rows) >= 20_000:
                        yield pd.DataFrame(rows, columns=["tid", "first", "key", "sid", "before", "segment"])
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["tid", "first", "key", "sid", "before", "segment"])

    return texts.mapInPandas(run, "tid binary, first long, key long, sid binary, before long, segment binary")


def _column_marks(segments: DataFrame, shards: int, length: int) -> DataFrame:
    """(sid, windows: ranges of window starts within the segment) by the
    column-wise construction, shard by shard."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        segs, before = [bytes(s) for s in pdf["segment"]], pdf["before"].to_numpy()
        found = repeated_windows(segs, pdf["key"].to_numpy(), before, length)
        rows = []
        for sid, b, s, f in zip(pdf["sid"], before, segs, found):
            windows = f[:b + 1][::-1][:len(s) - length + 1]  # by start: the farthest before the anchor comes first
            if windows.any():
                rows.append((sid, _ranges(windows)))
        return pd.DataFrame(rows, columns=["sid", "windows"])

    dealt = segments.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, "sid binary, windows array<array<long>>")


def _digest_marks(segments: DataFrame, length: int) -> DataFrame:
    """The same for the segments of hot anchors: windows counted by digest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for sid, key, before, s in zip(b["sid"], b["key"], b["before"], b["segment"]):
                n = len(s) - length + 1
                yield pd.DataFrame({"sid": [sid] * n, "start": range(n), "digest": [
                    hashlib.md5(b"%d:%d:" % (key, before - i) + s[i:i + length]).digest() for i in range(n)]})

    windows = written(segments.mapInPandas(run, "sid binary, start long, digest binary"), "hot-windows")
    several = written(windows.groupBy("digest").count().where("count > 1").select("digest"), "hot-repeats")
    return written(windows.join(several, "digest").select("sid", "start"), "hot-marks").groupBy("sid").agg(
        F.collect_set(F.array("start", "start")).alias("windows"))


def repeats(docs: DataFrame, length: int = LENGTH, shard_segments: int = SHARD_SEGMENTS,
            hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, spans (maximal
    removed byte runs), kept_sha256 (of the bytes that stay)."""
    modest_batches(docs.sparkSession, 500)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    source = source.withColumn("tid", F.unhex(F.md5("text")))
    rows = written(source.select("doc_id", "tid", F.octet_length("text").cast("long").alias("n_bytes"),
                                 F.sha2("text", 256).alias("sha256")), "rows")
    copies = written(rows.groupBy("tid").agg(F.count("*").alias("n"), F.min("doc_id").alias("one"), F.max("n_bytes").alias("n_bytes"))
                     .where("n > 1"), "copies")
    # one row of each text goes on: rows of other ids than the smallest are left out
    others = written(rows.join(small_side(copies), "tid").where(F.col("doc_id") != F.col("one")).select("doc_id", "tid"), "others")
    texts = source.where(F.octet_length("text") >= length).join(small_side(others), ["doc_id", "tid"], "left_anti")

    found = written(_anchor_table(texts.select("tid", "text"), length), "anchors")
    again = written(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeated-keys")
    wanted = written(found.join(again, "key"), "wanted")
    lists = written(wanted.groupBy("tid").agg(F.collect_list(F.struct("key", "place", "first", "last")).alias("at")), "lists")
    chosen = written(texts.select("tid", "text").join(small_side(lists.select("tid")), "tid", "left_semi")
                     .dropDuplicates(["tid"]), "chosen")
    segments = written(_segment_table(chosen.join(lists, "tid"), length), "segments")

    sids = written(segments.groupBy("sid").agg(F.count("*").alias("n"), F.first("key").alias("key"),
                                               F.first("before").alias("before"), F.first("segment").alias("segment")), "sids")
    per_key = written(sids.groupBy("key").agg(F.count("*").alias("different")).where("different > 1"), "keys")
    rivals = written(sids.join(per_key, "key").select("sid", "key", "before", "segment", "different"), "rivals")
    usual, hot = rivals.where(F.col("different") <= hot_segments), rivals.where(F.col("different") > hot_segments)
    shards = max(1, -(-usual.count() // shard_segments))
    marks = _column_marks(usual, shards, length)
    if not hot.isEmpty():
        marks = marks.union(_digest_marks(hot, length))
    whole = sids.where("n > 1").select("sid", F.array(F.array(F.lit(0).cast("long"), F.octet_length("segment").cast("long") - length)).alias("windows"))
    marks = written(marks.union(whole), "marks")
    # a segment's marks may come from both sides; ranges merge per text below
    spans = written(segments.select("sid", "tid", "first").join(marks, "sid").select(
        "tid", F.transform("windows", lambda w: F.array(w[0] + F.col("first"), w[1] + F.col("first") + length)).alias("ranges")), "ranges")
    per_text = spans.groupBy("tid").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            merged = [merge(x) for x in b["ranges"]]
            yield pd.DataFrame({"tid": b["tid"], "spans": merged, "kept_sha256": [
                hashlib.sha256(cut(t.encode("utf-8"), m)).hexdigest() for t, m in zip(b["text"], merged)]})

    shorter = chosen.join(per_text, "tid").mapInPandas(run, "tid binary, spans array<array<long>>, kept_sha256 string")
    gone = copies.where(F.col("n_bytes") >= length).select("tid", F.array(F.array(F.lit(0).cast("long"), "n_bytes")).alias("spans"),
                                                            F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"))
    changed = written(shorter.join(small_side(gone.select("tid")), "tid", "left_anti").union(gone), "changed")
    empty = F.array().cast("array<array<long>>")
    return rows.join(changed, "tid", "left").select(
        "doc_id", "n_bytes", F.coalesce("spans", empty).alias("spans"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256")).select(
        "doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans")
