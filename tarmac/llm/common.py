"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.session import ensure_checkpoint_dir, scratch_path, shuffles_dropped, ship_package

# Rows a broadcast side may hold.  Callers count first (a partial aggregate) and
# join by shuffle beyond it, so nothing unbounded is ever broadcast.
MAX_BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the table and recomputes nothing
    above it, and the shuffle files of the write go with it.  ``options`` are the writer's.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when it holds at most ``max_rows`` rows, else as it is.

    ``df`` must be stored (see :func:`saved`), as it is counted here.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def plain(docs: DataFrame, *cols: str) -> DataFrame:
    """Only ``cols``: whatever else a caller's table carries cannot clash with our names."""
    return docs.select(*[docs[c] for c in cols])


def release() -> None:
    """Give freed memory back: idle workers stay beside the executor for a while."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with this package importable in the workers."""

    def task(batches):
        yield from run(batches)
        release()

    ship_package(df.sparkSession)
    return df.mapInArrow(task, schema)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def others(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` but those with one of ``names``, in any case, as Spark compares names."""
    new = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in new]
