"""Best-fit packing of texts into bins of equal capacity under conflicts.

Lengths are words. A text longer than the capacity is cut into full pieces of
its own bin each and a rest. Pieces are packed best-fit decreasing: open bins
stand in order of their residual, and each carries a bitmap of the sources and
one of the duplicate clusters it holds. The successor search starts at the
smallest residual that fits and goes on until a bin has no conflict, so the
tightest compatible bin is found; else a bin is opened. A bin never holds two
pieces of one duplicate cluster, nor more than ``per_source`` pieces of one
source.

Work is split into shards of about SHARD pieces by a hash of document and
piece, so a source or cluster with a third of all rows spreads over all of
them; shards pack alone, and bins are named by shard and number.

Defined results: null and empty texts have length 0 and take no room but do
take part in the conflicts; a null source is a source of its own; rows that
repeat a doc_id that isn't null conflict, as equal texts do. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnscope.llm.common import text_or_empty, written

CAPACITY = 2048
PER_SOURCE = 2
#: Pieces a shard aims at; the number of shards follows the input.
SHARD = 2000


class Bins:
    """Open bins ordered by residual. A source may stand ``per_source`` times in
    a bin, so a bin has one bitmap of sources per level: level i holds the
    sources that stand more than i times."""

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []  # (residual, bin)
        self.sources: list[list[int]] = []
        self.clusters: list[int] = []

    def add(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset of a piece; source and cluster are bits."""
        i = bisect_left(self.order, (length, -1))
        while i < len(self.order):
            residual, b = self.order[i]
            if not (self.sources[b][-1] & source or self.clusters[b] & cluster):
                del self.order[i]
                break
            i += 1
        else:
            residual, b = self.capacity, len(self.sources)
            self.sources.append([0] * self.per_source)
            self.clusters.append(0)
        for level in range(self.per_source):
            if not self.sources[b][level] & source:
                self.sources[b][level] |= source
                break
        self.clusters[b] |= cluster
        insort(self.order, (residual - length, b))
        return b, self.capacity - residual


def pack_shard(pieces: pd.DataFrame, capacity: int, per_source: int, by_doc: bool = False) -> pd.DataFrame:
    """Bin number and offset of each piece (columns length, source, cluster,
    doc_id, piece), longest first, ties by document and piece. ``by_doc``: a
    doc_id that stands in several clusters is a cluster too."""
    pieces = pieces.sort_values(["length", "doc_id", "piece", "cluster"], ascending=[False, True, True, True], na_position="last")
    bins, source_bit, cluster_bit, got = Bins(capacity, per_source), {}, {}, []
    repeats = set()
    if by_doc:
        n = pieces.dropna(subset="doc_id").groupby("doc_id")["cluster"].nunique()
        repeats = set(n.index[n > 1])
    for length, source, cluster, doc in zip(pieces["length"], pieces["source"], pieces["cluster"], pieces["doc_id"]):
        s = source_bit.setdefault(source, 1 << len(source_bit))
        c = cluster_bit.setdefault(cluster, 1 << len(cluster_bit))
        if doc in repeats:
            c |= cluster_bit.setdefault(("doc", doc), 1 << len(cluster_bit))
        got.append(bins.add(int(length), s, c))
    return pieces.assign(bin=[b for b, _ in got], bin_offset=[o for _, o in got])


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard: int = SHARD,
         cluster: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start and length in words, shard, bin,
    bin_offset, capacity. ``cluster`` names a column of duplicate clusters;
    without it equal texts and equal doc_ids are clusters."""
    words = F.size(F.filter(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    norm = F.md5(F.trim(F.regexp_replace(text_or_empty(), r"[\x20\x09-\x0D]+", " ")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("\x00none")).alias("source"),
                       words.cast("long").alias("n_words"),
                       (F.coalesce(F.col(cluster).cast("string"), F.lit("\x00none")) if cluster else norm).alias("cluster"))
    full = F.floor(F.greatest(F.col("n_words") - 1, F.lit(0)) / capacity)
    pieces = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), full)).alias("piece")).select(
        "doc_id", "source", "cluster", "piece", (F.col("piece") * capacity).alias("start"),
        F.least(F.col("n_words") - F.col("piece") * capacity, F.lit(capacity)).cast("long").alias("length"))
    pieces = written(pieces, "pieces")
    shards = max(1, -(-pieces.count() // shard))
    # the salt of equal rows differs by their place, so a group of copies spreads too
    spread = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(shards)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(pdf, capacity, per_source, cluster is None)[["doc_id", "piece", "start", "length", "shard", "bin", "bin_offset"]]

    packed = spread.groupBy("shard").applyInPandas(
        run, "doc_id long, piece long, start long, length long, shard long, bin long, bin_offset long")
    return packed.withColumn("capacity", F.lit(capacity).cast("long"))
