"""Session construction and shared-storage locations.

Everything that must survive an executor loss (checkpoints, landed files,
materialised tables) lives under the folder named by ``spark.checkpoint.dir``.
That setting is read from the session; a directory of our own is only set when
the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session defaults for the analytics jobs.  Shuffle partitions are sized per
# run by the caller; AQE coalesces small partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Wide projections generate large methods; above HotSpot's 8000-byte
    # JIT limit they would run interpreted, so fall back to per-operator
    # codegen for such subtrees (the documented setting for HotSpot).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Malformed-row detection must not depend on which columns a query
    # selects: with CSV parser pruning a ragged row is only flagged when its
    # missing fields are among the selected ones.  The load writes every
    # column anyway, so nothing is lost.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
FOLDER_WRITERS = 4           # open files of a task; more Parquet writers at once cost more than the sort
LOAD_WRITERS = 2             # a landed file's month and its rejects: such a task sorts nothing
GZIP_TASK = 16 << 20         # bytes of gzip CSV a task takes; its rows take some 40 times that in memory
ARROW_BATCH = 8 << 20        # bytes of rows sent to a Python worker at once
LANDED_TASK = 32 << 20       # shuffled bytes of the rows of one landed file


def for_wide_rows(spark: SparkSession) -> None:
    """Set the limit of ``DEFAULT_CONF`` on generated methods, unless the session has one of its own.

    The 110 columns of a raw row make methods that HotSpot would otherwise interpret.
    """
    if int(spark.conf.get(HUGE_METHOD)) == 65535:              # Spark's default
        spark.conf.set(HUGE_METHOD, DEFAULT_CONF[HUGE_METHOD])


@contextmanager
def unsorted_folders(spark: SparkSession, writers: int = FOLDER_WRITERS) -> Iterator[None]:
    """Within it, writes into partition folders keep up to ``writers`` files open per task.

    Else Spark sorts each task's rows by folder first, and spills what its memory does
    not hold.  Rows of further folders are still sorted.
    """
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(writers)):
        yield


@contextmanager
def small_gzip_tasks(spark: SparkSession) -> Iterator[None]:
    """Within it, a task reads one gzip file or ``GZIP_TASK`` bytes of smaller ones.

    With Spark's 128 MB a task that sorts its rows by folder spills them.
    """
    with _setting(spark, "spark.sql.files.maxPartitionBytes", str(GZIP_TASK)):
        yield


@contextmanager
def small_landed_files(spark: SparkSession) -> Iterator[None]:
    """Within it, rebalanced tasks take ``LANDED_TASK`` shuffled bytes, for gzip files near ``GZIP_TASK``."""
    with _setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(LANDED_TASK)):
        yield


@contextmanager
def small_arrow_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, rows go to Python workers in batches of about ``ARROW_BATCH`` bytes.

    Spark counts 10,000 rows, 20 MB and more of texts, which executor and worker both
    hold.  Written and read tables keep their sizes.
    """
    with _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH)):
        yield


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, a write's shuffle files go as soon as it ends (Spark 4.1; older ones keep them).

    Else they stay on disk until the driver's garbage collection finds them unused.
    """
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tarmac", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/object "
                               "store) that every executor can reach")
        # local mode only (tests): a fresh folder per session
        configured = tempfile.mkdtemp(prefix="tarmac-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """Base folder for derived tables: the configured checkpoint dir itself.

    ``getCheckpointDir`` appends a per-application UUID; files written for
    later runs (landing zones, materialised models) go next to it so they
    outlive one application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return os.path.dirname(ensure_checkpoint_dir(spark).rstrip("/"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one run of ``name``."""
    return f"{shared_root(spark)}/tarmac/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(total_cores: int, largest_shuffle_bytes: int,
                 split_bytes: int = 256 << 20, reducer_bytes: int = 256 << 20) -> dict:
    """Split and shuffle sizing for a cluster with ``total_cores`` task slots.

    Reducer count follows the bytes of the largest shuffle, not the input
    size: shuffle blocks are maps x reducers, so over-partitioning a 100 TB
    scan's shuffles would create ~10^11 tiny blocks.  In this engine most
    shuffles carry partial aggregates (tiny); the largest is the hashed
    uniqueness check, about 16 bytes per fact row.

    * input splits of ``split_bytes`` (parquet row groups / files);
    * initial shuffle partitions = largest shuffle / ``reducer_bytes``,
      rounded up to whole task waves; AQE coalesces small partitions to the
      advisory size and splits skewed ones;
    * broadcast stays an explicit, size-checked decision (``small_side``),
      with Spark's automatic threshold kept at its small default.
    """
    needed = max(1, -(-largest_shuffle_bytes // reducer_bytes))
    waves = -(-needed // total_cores)
    partitions = max(total_cores * 2, waves * total_cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(reducer_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(reducer_bytes * 4),
        "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
    }


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the session was started.

    Sends a zip of the package's sources (well under a megabyte) once per application.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tarmac_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tarmac-py-"), "tarmac_src.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._tarmac_shipped = True
