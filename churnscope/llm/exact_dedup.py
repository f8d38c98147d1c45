"""Exact deduplication as a stateful stream.

The documents' digests are a stream; the keyed state (digest -> stable
identifier, content locator, number of rows) lives in RocksDB on the
executors' disks with its change log in the shared checkpoint folder, and
never expires. Rows of a micro-batch are combined before the shuffle
(streaming aggregation is partial on the map side), so a digest that a third
of all rows carry reaches the state as one row per task. Texts never enter
the state: a hit (a digest seen before) is confirmed afterwards on the full
normalised bytes, against the text that the state's locator names.

Defined results: null text counts as empty; all empty texts are one group.
Null doc_id sorts after every other. Of rows that repeat a doc_id within a
group exactly one is kept (the earlier locator). An empty table gives no rows.
Extra columns are ignored. Should two different texts share the state's
digest, their group is split by the text's own SHA-256, and each part keeps
its own smallest doc_id.

``dedup`` on one table makes a state for that call. With ``state``, a folder
that outlives the call, tables arrive as named deliveries: the stream goes on
from its checkpoint, digests of a new delivery meet the retained state of the
earlier ones, and the result is that of all deliveries so far. A delivery whose
name is there already is not counted again, so a call that died is repeated
with the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnscope.llm.common import shared_path, small_side, text_or_empty, written

#: State on disk; no pre-allocated files, as there may be many small stores.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Micro-batches that one table is dealt to, so that digests meet kept state.
BATCHES = 3


def normalised(name: str = "text") -> Column:
    """Null is empty; each run of space, tab, LF, VT, FF, CR is one space."""
    return F.regexp_replace(text_or_empty(name), r"[\x20\x09-\x0D]+", " ")


def sha256(c: Column) -> Column:
    return F.unhex(F.sha2(c, 256))


def digest_state(stream: DataFrame, files: str, checkpoint: str) -> None:
    """Run the stateful query over ``stream`` (digest, doc_id, locator) until
    its present input is read. Each micro-batch writes the states it changed
    to ``files/batch=N``; a batch that is run again replaces its own folder."""
    spark = stream.sparkSession
    changed = stream.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")).alias("first"),
        F.count("*").alias("group_size"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{files}/batch={number}")

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        query = (changed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).foreachBatch(keep).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def file_count(spark: SparkSession, path: str) -> int:
    """Files below a folder, from the file system's summary of it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getFileCount()


def is_written(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def dedup(docs: DataFrame, files_per_batch: int | None = None, digest: Callable[[Column], Column] = sha256,
          state: str | None = None, delivery: str = "") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256,
    locator (delivery, and the row's place in its digest table).

    ``files_per_batch`` bounds a micro-batch (None: BATCHES micro-batches for
    the files of this call); ``digest`` maps the normalised text to the state's
    key (tests pass a weak one to force collisions). ``state`` is a folder that
    all executors reach, to go on from; then ``delivery`` names this table, the
    normalised texts are kept beside the digests (full bytes of hits are checked
    across deliveries), and the result has the rows of every delivery.
    """
    spark = docs.sparkSession
    folder = state or shared_path(spark, "dedup")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("norm"))
    keyed = texts.withColumn("digest", digest(F.col("norm")))
    table = keyed.select("doc_id", "digest", F.sha2("norm", 256).alias("text_sha256"),
                         F.struct(F.lit(delivery).alias("delivery"), F.monotonically_increasing_id().alias("row")).alias("locator"),
                         *(["norm"] if state else []))
    path = f"{folder}/rows/of-{delivery}"
    if not is_written(spark, path):
        table.write.mode("overwrite").parquet(path)  # files of an unfinished write are not in the folder yet
    every = spark.read.schema(table.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/rows")
    rows = every.drop("norm")
    if state:
        keyed = every.select("doc_id", "norm", "digest")
    if rows.isEmpty():
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                           F.lit(False).alias("kept"), "text_sha256", "locator")
    files = f"{folder}/changes"
    stream = (spark.readStream.schema(rows.select("doc_id", "digest", "locator").schema).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", files_per_batch or -(-file_count(spark, path) // BATCHES)).parquet(f"{folder}/rows"))
    digest_state(stream, files, f"{folder}/checkpoint")
    # the last state of each digest: its count only grows, its first row only falls
    states = written(spark.read.parquet(files).groupBy("digest").agg(
        F.min("first").alias("first"), F.max("group_size").alias("group_size")), "state")

    several = states.where("group_size > 1").select("digest", F.col("first.doc_id").alias("keep_id"))
    hits = written(keyed.join(small_side(several), "digest"), "hits")
    held = written(hits.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(
        "digest", F.col("norm").alias("held")).dropDuplicates(["digest"]), "held")
    # no aggregate below or above this join: adaptive execution may then split a digest with many rows
    clash = written(hits.join(held, "digest").where("norm != held").select("digest"), "clashes").distinct()

    out = rows.join(states, "digest").select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("locator") == F.col("first.locator")).alias("kept"), "text_sha256", "locator", "digest")
    if clash.isEmpty():
        return out.drop("digest")
    # different texts under one digest: their rows are grouped by the text's own SHA-256
    apart = rows.join(clash, "digest", "left_semi")
    first = apart.groupBy("digest", "text_sha256").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")).alias("first"),
        F.count("*").alias("group_size"))
    split = apart.join(first, ["digest", "text_sha256"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("locator") == F.col("first.locator")).alias("kept"), "text_sha256", "locator")
    return out.join(clash, "digest", "left_anti").drop("digest").unionByName(split)
