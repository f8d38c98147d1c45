"""Session helpers: the configuration the jobs are written for."""

from __future__ import annotations

import importlib.util
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# SQL settings the plans rely on. All are runtime-settable, so they are
# applied to an existing session too (``tune``).
RUNTIME_CONF = {
    # runtime re-planning: coalesce small shuffle partitions, split skewed
    # ones, switch to broadcast when a side turns out small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when the split adds a shuffle for
    # the aggregate that follows (per-customer joins are followed by a
    # per-customer aggregate)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # timestamps in the data are wall-clock (timestamp_ntz); keep any
    # conversion deterministic
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the plans are designed for."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "churnscope") -> SparkSession:
    """Build (or reuse) a session. Local defaults only apply to local runs."""
    master = master or os.environ.get("CHURNSCOPE_MASTER", "local[*]")
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master.startswith("local"):
        # one JVM: there is no other executor to wait for
        builder = (builder.config("spark.driver.memory", "16g")
                   .config("spark.locality.wait", "0s"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions",
                                 str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Python workers import this package; where they can't (it is neither
    installed there nor on their path), it is sent along with ``addPyFile``."""
    sc = spark.sparkContext
    if getattr(sc, "_churnscope_shipped", False):
        return
    sc._churnscope_shipped = True
    # built-in functions only: the probe itself must not need the package
    if not sc.parallelize(["churnscope"], 1).map(importlib.util.find_spec).map(bool).first():
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        # Spark hands the archive to every executor
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="churnscope-package-"), "churnscope"), "zip", root, "churnscope"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; it is read from the session and never
    replaced. Only a local session without one gets a private folder.
    """
    ship_package(spark)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(the distributed rank cuts lineage with checkpoint())")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="churnscope-ckpt-"))
    return sc.getCheckpointDir()


def input_bytes(df) -> int:
    """Bytes on storage of the files that ``df`` scans."""
    files = df.inputFiles()
    if not files:
        return 0
    sizes = df.sparkSession.read.format("binaryFile").load(files).agg({"length": "sum"})
    return int(sizes.first()[0] or 0)


def size_shuffles(spark: SparkSession, source, target_bytes: int = 256 << 20) -> int:
    """Set how many partitions adaptive execution starts from, for the input at
    hand: one per ``target_bytes`` of its files, at least two per core. It is
    set anew for every run and leaves ``spark.sql.shuffle.partitions`` alone;
    adaptive execution merges what turns out small. Returns the number."""
    n = max(2 * spark.sparkContext.defaultParallelism, -(-input_bytes(source) // target_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n
