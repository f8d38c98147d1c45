"""Distributed ordering primitives: global rank, running totals, exact
quantiles.

A ``row_number()`` window without ``partitionBy`` moves every row into a
single task. Here the table is range-partitioned on the full sort key
(which includes a unique tie-break, so even a value shared by a third of
all rows is spread over many partitions), each partition is sorted
locally, and a rank is local position + the number of rows in all earlier
partitions. The per-partition counts are one row per partition, so the
offset table broadcast back is bounded by the partition count.

Range bounds come from sampling, so the partitioned table is written with
a reliable ``checkpoint()`` (under ``spark.checkpoint.dir``) before it is
read twice; a recomputation after an executor loss then reads the same
rows and cannot shift a row into another partition.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnscope.session import ensure_checkpoint_dir

_ROW_BITS = 33           # monotonically_increasing_id: partition << 33 | row
_ROW_MASK = (1 << _ROW_BITS) - 1


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


@contextmanager
def intermediates(spark, remove: bool):
    """A folder of its own for what one run writes with ``materialize`` (from
    this thread, or threads given its context); with ``remove`` it is deleted at
    the end. Tables of other runs are never touched."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/churnscope-run-{uuid.uuid4().hex}"
    token = _FOLDER.set(folder)
    try:
        yield folder
    finally:
        _FOLDER.reset(token)
        if remove:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    read it back: lineage is cut, and later scans still get column pruning
    and filter pushdown (unlike an RDD checkpoint)."""
    spark = df.sparkSession
    root = _FOLDER.get() or f"{ensure_checkpoint_dir(spark).rstrip('/')}/churnscope-tables"
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _range(df: DataFrame, order_cols: list, num_partitions: int | None) -> DataFrame:
    """Range-partition on the full sort key. Without an explicit count the
    exchange uses the session's shuffle partitions and adaptive execution
    may merge neighbouring small ranges (a merged partition is still one
    contiguous range, and positions are taken after the merge)."""
    if num_partitions:
        return df.repartitionByRange(num_partitions, *order_cols)
    return df.repartitionByRange(*order_cols)


def global_rank(df: DataFrame, order_cols: list, out: str = "rank",
                total_col: str | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in the total order ``order_cols``.

    ``order_cols`` must identify a row (append the key as tie-break): the
    rank is then exactly ``row_number() over (order by order_cols)``.
    ``total_col`` optionally adds the row count of the whole table.
    """
    tagged = (_range(df, order_cols, num_partitions)
              .sortWithinPartitions(*order_cols)
              .withColumn("_rid", F.monotonically_increasing_id()))
    tagged = reliable_checkpoint(tagged)
    pid = F.shiftright(F.col("_rid"), _ROW_BITS)
    counts = tagged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_tot"))
    ranked = (tagged.withColumn("_pid", pid)
              .join(F.broadcast(offsets), "_pid")
              .withColumn(out, (F.col("_off") + F.col("_rid").bitwiseAND(F.lit(_ROW_MASK))
                                + F.lit(1)).cast("bigint")))
    if total_col:
        ranked = ranked.withColumn(total_col, F.col("_tot").cast("bigint"))
    return ranked.drop("_pid", "_off", "_rid", "_tot", "_cnt")


def multi_rank(df: DataFrame, key: str, metrics: dict, prefix: str = "_rk_",
               total_col: str = "_n", num_partitions: int | None = None) -> DataFrame:
    """Ranks of several columns at once, ties broken by ``key``.

    The table is turned into a narrow long form (metric index, value, key),
    ranked once in the order (metric, value, key), and pivoted back. Every
    metric contributes exactly n rows, so a row's rank inside its metric is
    its combined rank minus ``metric_index · n``. One range shuffle of three
    narrow columns replaces one wide shuffle per metric. Values of all
    metrics must share one orderable type (e.g. bigint).
    Adds ``<prefix><name>`` per metric and ``total_col`` (n).
    """
    names = list(metrics)
    entries = [F.struct(F.lit(i).alias("_m"), F.col(c).alias("_v") if isinstance(c, str)
                        else c.alias("_v")) for i, c in enumerate(metrics[n] for n in names)]
    long = df.select(F.col(key), F.explode(F.array(*entries)).alias("_e")).select(
        key, "_e._m", "_e._v")
    ranked = global_rank(long, [F.col("_m"), F.col("_v"), F.col(key)], "_rk",
                         total_col="_total", num_partitions=num_partitions)
    n = (F.col("_total") / len(names)).cast("bigint")
    per = ranked.select(key, "_m", (F.col("_rk") - F.col("_m") * n).alias("_rk"),
                        n.alias(total_col))
    wide = per.groupBy(key, total_col).pivot("_m", list(range(len(names)))).agg(F.first("_rk"))
    wide = wide.select(key, total_col, *[F.col(str(i)).alias(f"{prefix}{name}")
                                         for i, name in enumerate(names)])
    return df.join(wide, key)


def running_total(df: DataFrame, order_cols: list, weights, outs,
                  num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of the ``weights`` columns along the total
    order ``order_cols`` (which must identify a row): a window per range
    partition plus the totals of all earlier partitions."""
    weights = [weights] if isinstance(weights, str) else list(weights)
    outs = [outs] if isinstance(outs, str) else list(outs)
    tagged = (_range(df, order_cols, num_partitions)
              .withColumn("_pid", F.spark_partition_id()))
    tagged = reliable_checkpoint(tagged)
    totals = tagged.groupBy("_pid").agg(*[F.sum(w).alias(f"_pt{i}") for i, w in enumerate(weights)])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_pt{i}").over(before), F.lit(0)).alias(f"_off{i}")
                                      for i in range(len(weights))])
    local = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = tagged.join(F.broadcast(offsets), "_pid")
    for i, (w, o) in enumerate(zip(weights, outs)):
        out = out.withColumn(o, F.col(f"_off{i}") + F.sum(w).over(local))
    return out.drop("_pid", *[f"_off{i}" for i in range(len(weights))])


def lerp(a: Column, b: Column, t: Column) -> Column:
    """Linear interpolation written as NumPy does it (two branches keep
    the end points exact)."""
    diff = b - a
    return F.when(t >= 0.5, b - diff * (F.lit(1.0) - t)).otherwise(a + diff * t)


def quantile_from_rank(ranked: DataFrame, rank_col: str, value_col: str,
                       n_col: str, q: float, out: str = "quantile") -> DataFrame:
    """Linear-interpolated quantile ``q`` read off a ranked table: only
    the (at most) two rows at positions ⌊(n-1)q⌋+1 and +2 are touched.
    Returns one row."""
    h = F.lit(q) * (F.col(n_col) - 1).cast("double")
    lo = F.floor(h) + 1
    rows = (ranked.select(F.col(rank_col).alias("_r"), F.col(value_col).cast("double").alias("_v"),
                          h.alias("_h"), lo.alias("_lo"), F.col(n_col).alias("_n"))
            .filter((F.col("_r") == F.col("_lo")) |
                    (F.col("_r") == F.least(F.col("_lo") + 1, F.col("_n")))))
    agg = rows.agg(
        F.max(F.when(F.col("_r") == F.col("_lo"), F.col("_v"))).alias("_a"),
        F.max(F.when(F.col("_r") == F.least(F.col("_lo") + 1, F.col("_n")), F.col("_v"))).alias("_b"),
        F.max(F.col("_h") - F.floor(F.col("_h"))).alias("_t"))
    return agg.select(lerp(F.col("_a"), F.col("_b"), F.col("_t")).alias(out))


def exact_quantiles(df: DataFrame, value_col: str, qs: list[float],
                    num_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of a column over many rows, as one
    row with columns ``q_<i>`` in the order of ``qs``. Nulls are ignored."""
    many = exact_quantiles_of(df, [value_col], qs, num_partitions)
    # one row even where the column holds no value
    return many.agg(*[F.max(f"q_{i}").alias(f"q_{i}") for i in range(len(qs))])


def exact_quantiles_of(df: DataFrame, cols: list[str], qs: list[float],
                       num_partitions: int | None = None) -> DataFrame:
    """Exact quantiles of several columns of one type in one pass: (column
    index ``_m``, ``q_<i>`` …), one row per column that holds a value.

    The table becomes a long one (column, value), reduced to distinct values
    with counts (map-side combined); one running count along (column, value)
    serves all columns, and only the values covering the wanted positions are
    kept. The totals joined back have one row per column.
    """
    entries = F.array(*[F.struct(F.lit(i).alias("_m"), F.col(c).alias("_v")) for i, c in enumerate(cols)])
    vals = (df.select(F.explode(entries).alias("_e")).select("_e._m", "_e._v").filter(F.col("_v").isNotNull())
            .groupBy("_m", "_v").agg(F.count(F.lit(1)).alias("_c")))
    cum = running_total(vals, ["_m", "_v"], "_c", "_cum", num_partitions)
    sizes = cum.groupBy("_m").agg(F.sum("_c").alias("_n"), F.max("_cum").alias("_end"))
    x = cum.join(F.broadcast(sizes), "_m").withColumn("_cum", F.col("_cum") - F.col("_end") + F.col("_n"))
    wanted, aggs, out = None, [], []
    for i, q in enumerate(qs):
        h = F.lit(q) * (F.col("_n") - 1).cast("double")
        lo = F.floor(h)                      # 0-based position
        hi = F.least(lo + 1, F.col("_n") - 1)
        first = F.col("_cum") - F.col("_c")
        aggs += [F.max(F.when((first <= lo) & (lo < F.col("_cum")), F.col("_v").cast("double"))).alias(f"_a{i}"),
                 F.max(F.when((first <= hi) & (hi < F.col("_cum")), F.col("_v").cast("double"))).alias(f"_b{i}"),
                 F.max(h - lo).alias(f"_t{i}")]
        out.append(lerp(F.col(f"_a{i}"), F.col(f"_b{i}"), F.col(f"_t{i}")).alias(f"q_{i}"))
        near = (first <= hi) & (lo < F.col("_cum"))
        wanted = near if wanted is None else (wanted | near)
    return x.filter(wanted).groupBy("_m").agg(*aggs).select("_m", *out)
