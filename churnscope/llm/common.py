"""Helpers shared by the corpus operators: shared-folder tables, joins with a
side of checked size, and column picking that ignores extra columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.session import ensure_checkpoint_dir

#: A join side of at most this many narrow rows (ids, digests) may be broadcast.
BROADCAST_ROWS = 200_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share
    (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage
    is cut reliably, and later scans keep column pruning."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame) -> DataFrame:
    """``df`` (a written, narrow table) with a broadcast hint if its row count
    is within BROADCAST_ROWS; beyond it the join shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def modest_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long: hand Python workers Arrow batches of ``rows`` rows
    unless the session already asks for smaller ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    current = int(spark.conf.get(key, "10000"))
    if current <= 0 or current > rows:
        spark.conf.set(key, str(rows))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True where crc32 of doc_id as text has remainder 2 mod 4; a null id
    counts as the empty string."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def training_labels(labels_df: DataFrame, column: str) -> DataFrame:
    """(doc_id, y) of the rows that may train: not held out, label known.
    Of repeated or conflicting labels of one document the larger counts."""
    return (labels_df.select(F.col("doc_id").cast("long").alias("doc_id"),
                             F.col(column).cast("int").alias("y"))
            .where("doc_id is not null and y is not null").where(~held_out())
            .groupBy("doc_id").agg(F.max("y").alias("y")))


def hash_sample(df: DataFrame, rows: int, *key: str, total: int | None = None) -> DataFrame:
    """About the first ``rows`` rows of ``df`` (never more) by a hash of ``key``.
    Rows above the hash that should cut off a few more than ``rows`` are dropped
    before the sort, so tasks hand over little more than the sample together,
    however many they are. ``total``: the row count of ``df``, if known."""
    total = df.count() if total is None else total
    span = 1 << 40
    h = F.pmod(F.xxhash64(*key, F.lit(17)), F.lit(span))
    if total > 2 * rows:
        df = df.where(h < int(span * (rows + 4 * rows ** 0.5 + 10) / total))
    return df.orderBy(h, *key).limit(rows)
