"""Exact dedup: a stateful stream over content digests, then a check of full bytes.

``remember`` runs a Structured Streaming aggregation whose RocksDB state is keyed
by the digest and never expires: per digest it holds the identifier that stays,
the locator of that content and the number of rows seen.  New files only touch
the digests they contain; a restart goes on from the stream's checkpoint.
``resolve`` compares whole texts for every digest seen more than once, so a digest
collision splits into its true groups instead of losing a document.

Defined results: a null text is the empty text; empty texts equal each other; of
equal texts the row with the largest id stays, and rows repeating an id in full
form one group (each carries ``kept`` true: they are the same document).  Null
ids are allowed: they lose against any other id.  An empty table gives an empty
result.  Extra columns are ignored.  Texts of any length are hashed whole.  With a kept
state, rows whose file is gone count no more.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.llm.common import plain, saved, small_side, table
from tarmac.session import ensure_checkpoint_dir, scratch_path

# Input of one micro-batch; a first run over a large corpus is many batches.
MAX_BYTES_PER_TRIGGER = 256 << 30

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # state deltas are uploaded per batch, whole snapshots only now and then
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many partitions with little state each: no preallocated logs
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
}


def sha256_of(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


@contextmanager
def _conf(spark: SparkSession, values: dict):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column],
                 locator: Column | None = None) -> DataFrame:
    """(id, digest, locator); batch or streaming."""
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].alias("id"), digest(text).alias("digest"),
                       (locator if locator is not None else docs[id_col].cast("string")).alias("locator"))


def remember(stream: DataFrame, state_root: str) -> DataFrame:
    """Run ``stream`` of (id, digest, locator) to its end and return the state per digest.

    Every batch writes the digests it changed into its own folder, overwritten on
    a retry.  Counts and the largest id only grow, so the newest entry of a digest
    is the largest one.  The partial aggregate in front of the state turns a hot
    digest into one row per task.
    """
    spark = stream.sparkSession
    out = f"{state_root}/changes"
    entries = stream.groupBy("digest").agg(
        F.max(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("n"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with _conf(spark, STATE_CONF):
        query = (entries.writeStream.outputMode("update").foreachBatch(write)
                 .option("checkpointLocation", f"{state_root}/checkpoint")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    schema = entries.schema
    changes = spark.read.schema(schema).option("recursiveFileLookup", "true")
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return (changes.parquet(out).groupBy("digest")
            .agg(F.max("keep").alias("keep"), F.max("n").alias("n")))


def resolve(docs: DataFrame, state: DataFrame, id_col: str, text_col: str,
            digest: Callable[[Column], Column]) -> DataFrame:
    """One row per document: id, digest, keep_id, group_size, kept."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), text.alias("body"), digest(text).alias("digest"))
    # full bytes of every hit, grouped with map-side combining: a hot text becomes one row per task
    hits = saved(state.filter("n > 1").select("digest", "n", F.col("keep.id").alias("keep_id")), "dedup-hits")
    hit = small_side(hits.select("digest"))
    same = saved(rows.join(hit, "digest", "left_semi").groupBy("digest", "body")
                 .agg(F.max("id").alias("true_keep"), F.count(F.lit(1)).alias("true_n"))
                 .withColumn("texts", F.lit(1)), "dedup-bytes")
    # several texts under one digest, or rows of the state whose file is gone: what is there now counts
    now = same.groupBy("digest").agg(F.sum("texts").alias("texts"), F.sum("true_n").alias("now"),
                                     F.max("true_keep").alias("last"))
    clash = saved(now.join(hits, "digest").filter("texts > 1 OR now <> n OR NOT (last <=> keep_id)")
                  .select("digest"), "dedup-clash")
    seen = state.select("digest", F.col("keep.id").alias("keep_id"), F.col("n").alias("group_size"))
    unseen = F.raise_error(F.lit("exact dedup: a file was rewritten in place after it was read; "
                                 "start again with a new state_root"))
    whole = rows.select("id", "digest").join(small_side(clash), "digest", "left_anti").join(seen, "digest", "left")
    whole = whole.withColumn("group_size", F.coalesce("group_size", unseen.cast("long")))
    parts = [whole]
    if not clash.isEmpty():
        split = same.join(clash, "digest", "left_semi").withColumnsRenamed(
            {"true_keep": "keep_id", "true_n": "group_size"}).drop("texts")
        parts.append(rows.join(split, ["digest", "body"]).select("id", "digest", "keep_id", "group_size"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def file_stream(spark: SparkSession, path: str, max_bytes: int = MAX_BYTES_PER_TRIGGER,
                max_files: int | None = None) -> DataFrame:
    """Stream of a Parquet file or folder; files that arrive later are picked up by the next run."""
    limit = ("maxFilesPerTrigger", max_files) if max_files else ("maxBytesPerTrigger", max_bytes)
    # a pattern, because a stream takes a plain path for a folder and this may be one file
    return (spark.readStream.schema(spark.read.parquet(path).schema)
            .option("maxFileAge", "36500d").option(*limit).parquet(f"{path[:-1]}[{path[-1]}]"))


def dedup_files(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                state_root: str | None = None, digest: Callable[[Column], Column] = sha256_of,
                max_files: int | None = None) -> DataFrame:
    """Dedup the Parquet rows under ``path``; the file of the kept row is its locator.

    With a ``state_root`` of its own a later call reads only files that are new
    since, while the returned decisions cover the rows that are under ``path`` now: where
    files are gone, the groups of their rows are counted anew.  A file rewritten under
    its old name is an error.
    """
    ensure_checkpoint_dir(spark)
    path = path.rstrip("/")
    root = state_root or scratch_path(spark, "dedup-state")
    stream = file_stream(spark, path, max_files=max_files)
    state = remember(fingerprints(stream, id_col, text_col, digest, F.col("_metadata.file_path")), root)
    return resolve(plain(spark.read.parquet(path), id_col, text_col), saved(state, "dedup-seen"),
                   id_col, text_col, digest)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          digest: Callable[[Column], Column] = sha256_of) -> DataFrame:
    """Dedup a DataFrame: its fingerprints (not its texts) are stored and streamed."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    docs = plain(docs, id_col, text_col)
    prints = scratch_path(spark, "dedup-prints")
    fingerprints(docs, id_col, text_col, digest).write.parquet(prints)
    state = remember(file_stream(spark, prints), scratch_path(spark, "dedup-state"))
    return resolve(docs, saved(state, "dedup-seen"), id_col, text_col, digest)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_files(spark, f"{sf_dir}/documents.parquet").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("digest").alias("text_sha256"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of equal texts only the row with the largest doc_id goes on."""
    gone = dedup(docs).filter(~F.col("kept")).select(F.col("id").alias("_id"), F.col("digest").alias("_digest"))
    gone = small_side(saved(gone.distinct(), "dedup-gone"))
    same = docs["doc_id"].eqNullSafe(gone["_id"]) & (
        sha256_of(F.coalesce(docs["text"], F.lit(""))) == gone["_digest"])
    return docs.join(gone, same, "left_anti")
