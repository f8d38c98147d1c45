"""Hard-negative mining by a secondary-sort shuffle.

Every anchor is scored against every row, in blocks: rows are dealt into blocks
by a hash, anchors likewise, and one task holds one block of each. A block keeps
of an anchor's pairs only those that can be in the result: its first POSITIVES
of the same label, and, once the anchor's positives over all rows are known, the
first NEGATIVES in each positive's window. Both are exact, because the first k
of all rows are among the first k of every block, so an anchor's key holds a few
pairs a block however many rows there are.

The pairs that are left carry packed keys (anchor, descending score, positives
first, id): big-endian bytes whose order is the sort order.
``repartitionAndSortWithinPartitions`` brings an anchor's pairs together in that
order, and a streaming iterator reads them once: a positive opens a window, a
negative is emitted for every open window that takes it, a window closes when it
is full or passed. It holds the open windows of one anchor and nothing else.
Positives go before negatives of the same score, because a positive of score 0
takes negatives of score 0 with smaller ids too.

Scores are exact integers: blocks whose products stay below 2**53 use a matrix
product in doubles, others Python integers; a score that doesn't fit in 64 bits
raises (that of an anchor with itself included), as does a component of 2**62 or
more after scaling.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; an empty vector does (all its scores are 0). Only
vectors of one length meet. Rows that repeat an id are rows of their own, as
anchors too. Windows of positives with negative scores are empty. An anchor
without positives, or a positive without negatives, gives no rows; nor does an
empty table. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnscope.llm.common import written

POSITIVES = 5
NEGATIVES = 10
#: Per cent of the positive's score that a negative's score lies between.
LEAST, MOST = 30, 90
ROW_BLOCK = 8192
ANCHOR_BLOCK = 4096
SLICE = 128

KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
SIGN = 1 << 63
PAIR = "anchor long, key binary"


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v) of the rows that take part; v holds floor(scale * x)
    in doubles."""
    v = F.transform("embedding", lambda c: F.when(F.abs(c.cast("double") * scale) < 2.0 ** 62, F.floor(c.cast("double") * scale).cast("double"))
                    .otherwise(F.raise_error(F.lit("a scaled component is 2**62 or more")).cast("double")))
    whole = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where("vec_id is not null and label is not null and embedding is not null").where(whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of q with the rows of x."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2.0 ** 53:
        return (q @ x.T).astype(np.int64)
    exact = np.array([[int(c) for c in r] for r in q], object) @ np.array([[int(c) for c in r] for r in x], object).T
    if max(abs(exact.min()), abs(exact.max())) >= SIGN:
        raise OverflowError("an inner product does not fit in 64 bits")
    return exact.astype(np.int64)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


def pack(anchor: np.ndarray, score: np.ndarray, negative: bool, ids: np.ndarray) -> list[bytes]:
    """Keys whose byte order is (anchor, descending score, positives first, id)."""
    keys, flip = np.empty(len(ids), KEY), np.uint64(SIGN)
    keys["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ flip
    keys["score"] = ~(score.astype(np.int64).view(np.uint64) ^ flip)
    keys["kind"] = negative
    keys["id"] = ids.astype(np.int64).view(np.uint64) ^ flip
    whole = keys.tobytes()
    return [whole[i:i + KEY.itemsize] for i in range(0, len(whole), KEY.itemsize)]


def unpack(key: bytes) -> tuple[int, int, int, int]:
    """(anchor, score, kind, id) of a packed key."""
    number = lambda b: int.from_bytes(b, "big")
    return number(key[:8]) - SIGN, SIGN - 1 - number(key[8:16]), key[16], number(key[17:]) - SIGN


def block_positives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each anchor's first k rows of its label in the block, but itself."""
    rows = rows.sort_values("vec_id", kind="stable")
    out = []
    for label, some in anchors.groupby("label"):
        mine = rows[rows["label"] == label]
        ids, uids, x = mine["vec_id"].to_numpy(), mine["uid"].to_numpy(), matrix(mine["v"])
        for at in range(0, len(some), SLICE):
            part = some.iloc[at:at + SLICE]
            scores = products(matrix(part["v"]), x)
            order = np.argsort(-scores, axis=1, kind="stable")[:, :k + 1]
            for uid, s, o in zip(part["uid"], scores, order):
                o = o[uids[o] != uid][:k]
                out += zip([uid] * len(o), s[o].tolist(), ids[o].tolist())
    return pd.DataFrame(out, columns=["anchor", "score", "vec_id"]).astype("int64")


def block_negatives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, least: int, most: int) -> pd.DataFrame:
    """The packed pairs of each anchor with its first k rows of other labels in
    the window of each of its positives (``scores``)."""
    rows = rows.sort_values("vec_id", kind="stable")
    ids, labels, x = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["v"])
    uids, keys = [], []
    for at in range(0, len(anchors), SLICE):
        part = anchors.iloc[at:at + SLICE]
        scores = products(matrix(part["v"]), x)
        order = np.argsort(-scores, axis=1, kind="stable")
        for uid, label, positives, s, o in zip(part["uid"], part["label"], part["scores"], scores, order):
            o = o[labels[o] != label]
            falling, taken = -s[o], set()
            for p in {int(p) for p in positives}:
                if least * p <= most * p:
                    # the window is ceil(least p / 100) .. floor(most p / 100)
                    first = int(np.searchsorted(falling, -(most * p // 100), "left"))
                    past = int(np.searchsorted(falling, -least * p // 100, "right"))
                    taken.update(range(first, min(first + k, past)))
            if taken:
                o = o[sorted(taken)]
                uids += [uid] * len(o)
                keys += pack(np.full(len(o), uid), s[o], True, ids[o])
    return pd.DataFrame({"anchor": np.array(uids, np.int64), "key": keys})


def windows(keys: Iterator[bytes], k: int, least: int, most: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive score, negative score) from
    the sorted keys; holds the open windows of the current anchor."""
    current, opened = None, []
    for key in keys:
        anchor, score, kind, i = unpack(key)
        if anchor != current:
            current, opened = anchor, []
        if not kind:
            opened.append([i, score, 0])
            continue
        # a window whose lower end is passed takes nothing more
        opened = [w for w in opened if w[2] < k and least * w[1] <= 100 * score]
        for w in opened:
            if 100 * score <= most * w[1]:
                w[2] += 1
                yield anchor, w[0], w[2], i, w[1], score


def _dealt(column: str, blocks: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(blocks)).cast("int")


def mine(rows: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST,
         most: int = MOST, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK, partitions: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    for the ``rows`` (vec_id, label, v of whole doubles); rows whose vec_id is
    divisible by ``every`` are anchors."""
    spark = rows.sparkSession
    # a row's number only tells rows with one id apart; it is fixed by writing it
    rows = written(rows.withColumn("uid", F.monotonically_increasing_id()).withColumn("d", F.size("v")), "hn-rows")
    anchors = rows.where(F.col("vec_id") % every == 0)
    n_rows, n_anchors = rows.count(), anchors.count()
    by_row, by_anchor = max(1, -(-n_rows // row_block)), max(1, -(-n_anchors // anchor_block))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    row_side = rows.withColumn("rb", _dealt("uid", by_row, 3)).withColumn("ab", all_of(by_anchor))
    place = ["d", "ab", "rb"]

    def in_blocks(asked: DataFrame, found, schema: str) -> DataFrame:
        side = asked.withColumn("ab", _dealt("uid", by_anchor, 4)).withColumn("rb", all_of(by_row))
        return side.groupBy(*place).cogroup(row_side.groupBy(*place)).applyInPandas(found, schema)

    first = in_blocks(anchors, lambda a, r: block_positives(a, r, positives), "anchor long, score long, vec_id long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    best = written(first.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives), "hn-positives")
    scores = best.groupBy("anchor").agg(F.collect_list("score").alias("scores"))
    asked = written(anchors.join(scores, anchors["uid"] == scores["anchor"]).select("uid", "label", "v", "d", "scores"), "hn-asked")
    pairs = in_blocks(asked, lambda a, r: block_negatives(a, r, negatives, least, most), PAIR)

    def opening(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"anchor": b["anchor"], "key": pack(b["anchor"].to_numpy(), b["score"].to_numpy(), False, b["vec_id"].to_numpy())})

    keyed = pairs.select("key").unionByName(best.mapInPandas(opening, PAIR).select("key"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_keys = keyed.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(n, lambda key: zlib.crc32(key[:8]))
    out = sorted_keys.mapPartitions(lambda part: windows((key for key, _ in part), negatives, least, most))
    named = spark.createDataFrame(out, "uid long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    names = anchors.select("uid", F.col("vec_id").alias("anchor_id"))
    return named.join(names, "uid").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
