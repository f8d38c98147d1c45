"""Corpus pipeline: quality classifier, exact deduplication, order-MinHash
near-deduplication, secret scan with redaction, best-fit packing.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage
before kept and returns a DataFrame; ``run`` writes each stage's result as
Parquet to the shared folder and reads it back as the next stage's documents.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm import exact_dedup, order_minhash, packing, quality_qda, secrets_crf
from churnscope.llm.common import documents, labels, small_side, text_or_empty, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _kept(docs: DataFrame, key: Column, decided: DataFrame, once: bool) -> DataFrame:
    """The rows of ``docs`` that ``decided`` (doc_id, key, kept) keeps; a row is
    known by its doc_id and ``key``, a value of its text. ``once``: of rows that
    agree in both, one stays."""
    per_row = decided.groupBy(F.col("doc_id").alias("id"), "key").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    few = written(per_row.where("not kept or n > 1"), "decided")
    rows = docs.select(*COLUMNS, key.alias("row_key"))

    def same(side: DataFrame) -> Column:
        return rows["doc_id"].eqNullSafe(side["id"]) & (rows["row_key"] == side["key"])

    gone = small_side(few if once else few.where("not kept"))
    left = rows.join(gone, same(gone), "left_anti").select(*COLUMNS)
    several = few.where("kept and n > 1")
    if not once or several.isEmpty():
        return left
    again = rows.join(several, same(several), "left_semi").dropDuplicates(["doc_id", "row_key"])
    return left.unionByName(again.select(*COLUMNS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    scored = quality_qda.score(docs, labels(spark, sf_dir))
    return _kept(docs, F.md5(text_or_empty()), scored.select("doc_id", F.col("text_md5").alias("key"), (F.col("predicted") == 1).alias("kept")), False)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    found = exact_dedup.dedup(docs).select("doc_id", F.col("text_sha256").alias("key"), "kept")
    return _kept(docs, F.sha2(exact_dedup.normalised(), 256), found, True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the smallest id."""
    found = order_minhash.classes(docs).select("doc_id", F.col("text_md5").alias("key"), "kept")
    return _kept(docs, F.md5(order_minhash.normalised()), found, True)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced by [SECRET]; no document goes."""
    redacted = secrets_crf.redact(docs, secrets_crf.train(docs))
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their bins; no document goes."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("secret scans", secrets),
    ("best-fit packing", packed),
]

#: SQL can't express the classifiers, the sketches and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
