"""Writers: landed gzip CSV (recompression), ingestion log, materialised tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.constants import (
    CSV_QUOTE, LOG_STATUS, LOG_STEP, PIPELINE_NAME, SCHEDULED_PIPELINE_NAME, SOURCE_SYSTEM,
)
from tarmac.functions.scalar import utc_ntz, utc_offset_iso
from tarmac.session import small_landed_files, unsorted_folders
from tarmac.sources.schema import FILE_COLUMNS

LANDED_GLOB = "*.csv.gz"   # Spark names the part files itself
# a row as one text and back: nothing trimmed, no length limit; '' comes back as NULL, as a load takes it
_AS_TEXT = {"quote": CSV_QUOTE, "escape": CSV_QUOTE, "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1", "maxColumns": "100000"}


def landed_months(spark, out: str) -> list[tuple[int, int]]:
    """(year, month) folders already present under ``out`` (a metadata-only
    listing through the Hadoop FileSystem API; no file is read).  Rows without a
    year or month are in (0, 0)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(out)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = set()
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{out}/{{,source=*/}}year=*/month=*")) or []:
        parts = str(status.getPath().toString()).split("/")[-2:]
        year, month = parts[0][5:], parts[1][6:]
        if status.isDirectory() and year.isdigit() and month.isdigit():
            found.add((int(year), int(month)))
    return sorted(found)


def land_csv_gz(df: DataFrame, out: str, year_col: str = "Year", month_col: str = "Month",
                columns: Sequence[str] = FILE_COLUMNS, mode: str = "append",
                max_records_per_file: int = 2_000_000, source: str | None = None) -> bool:
    """Write rows as gzip CSV in ``year=YYYY/month=MM`` folders (month zero-padded).

    Data columns are written under positional names ``_c0..`` in file order:
    the header is ignored on load (positional mapping) and real names would
    collide case-insensitively with the ``year``/``month`` folder columns.
    Columns missing from ``df`` are written empty; a row without a year or month
    goes to ``year=0000/month=00``.  Rows are rebalanced by month, so the number
    of files follows the data (AQE joins small months' tasks and splits large
    ones), not tasks times months.  They are shuffled as one text of the columns that
    ``df`` has, a third of the row's size.

    ``source`` names the object the rows come from.  Its rows land in a folder of
    their own, ``source=<name>``; an object that has landed whole is skipped
    (returns False), a failed landing is replaced.  Other objects' rows for the
    same months are never touched.
    """
    spark = df.sparkSession
    have = {c: f"_c{i}" for i, c in enumerate(columns) if c in df.columns}
    year = F.coalesce(F.lpad(F.col(year_col).try_cast("int").cast("string"), 4, "0"), F.lit("0000"))
    month = F.coalesce(F.lpad(F.col(month_col).try_cast("int").cast("string"), 2, "0"), F.lit("00"))
    line = F.to_csv(F.struct(F.lit("").alias("_"), *[F.col(c).alias(n) for c, n in have.items()]), _AS_TEXT)
    rows = df.select(line.alias("line"), year.alias("year"), month.alias("month"))
    if source is not None:
        out, mode = f"{out.rstrip('/')}/source={source}", "overwrite"
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/_SUCCESS")
        if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            return False
    rows = spark.sql("SELECT /*+ REBALANCE(year, month) */ * FROM {rows}", rows=rows)
    row = F.from_csv("line", ", ".join(f"{n} string" for n in ("_", *have.values())), _AS_TEXT)
    rows = rows.select(row.alias("r"), "year", "month").select(
        *[(F.col("r")[have[c]] if c in have else F.lit(None).cast("string")).alias(f"_c{i}")
          for i, c in enumerate(columns)], "year", "month")
    with small_landed_files(spark), unsorted_folders(spark):
        (rows
           .write.mode(mode)
           .option("maxRecordsPerFile", max_records_per_file)
           .partitionBy("year", "month")
           .option("header", "true").option("quote", CSV_QUOTE).option("escape", CSV_QUOTE)
           .option("compression", "gzip")
           .csv(out))
    return True


# --- fixed values: fields of the short (scheduled-run) log record ---
DAG_LOG_FIELDS = ("pipeline_name", "year", "month", "s3_key", "file_size_bytes", "file_sha256",
                  "uploaded_at_utc", "status")


def ingestion_log(manifest: DataFrame, uploaded_at=None, variant: str = "full",
                  pipeline_name: str | None = None, aws_region: str | None = None) -> DataFrame:
    """One log record per landed file from a file manifest with columns
    ``path, size, sha256, year, month``: 13 fields (``variant="full"``) or
    the 8-field record of the scheduled run (``variant="dag"``).
    ``uploaded_at`` may be injected; it defaults to the job's start time.
    ``log_name`` comes after the fields: the record's own file name."""
    if variant not in ("full", "dag"):
        raise ValueError(f"unknown log variant {variant!r}")
    ts = F.current_timestamp() if uploaded_at is None else F.lit(uploaded_at).cast("timestamp")
    label = pipeline_name or (PIPELINE_NAME if variant == "full" else SCHEDULED_PIPELINE_NAME)
    stamp = F.date_format(utc_ntz(ts), "yyyyMMdd'T'HHmmss'Z'")
    full = manifest.select(
        F.lit(label).alias("pipeline_name"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.lit(LOG_STEP).alias("step"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.regexp_extract("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/]*)", 1).alias("s3_bucket"),
        F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?/?", "").alias("s3_key"),
        F.lit(aws_region).cast("string").alias("aws_region"),
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.col("size").cast("long").alias("file_size_bytes"),
        F.col("sha256").alias("file_sha256"),
        utc_offset_iso(ts).alias("uploaded_at_utc"),
        F.lit(LOG_STATUS).alias("status"),
        F.concat(F.lit("ingestion_"), F.col("year").cast("string"), F.lit("_"),
                 F.lpad(F.col("month").cast("string"), 2, "0"), F.lit("_gzip_"), stamp, F.lit(".json")).alias("log_name"),
    )
    return full.select(*DAG_LOG_FIELDS, "log_name") if variant == "dag" else full


def write_ingestion_log(manifest: DataFrame, out: str, uploaded_at=None, **kwargs) -> None:
    """Append the log records as JSON, every field written (NULL too), under
    ``log_year=/log_month=`` folders."""
    (ingestion_log(manifest, uploaded_at, **kwargs)
       .withColumn("log_year", F.col("year")).withColumn("log_month", F.lpad(F.col("month").cast("string"), 2, "0"))
       .write.mode("append").option("ignoreNullFields", "false").partitionBy("log_year", "log_month").json(out))


def write_log_documents(manifest: DataFrame, out: str, uploaded_at=None, **kwargs) -> list[str]:
    """Write every log record as a JSON file of its own under ``year=/month=``, named ``log_name``.

    Records are written aside by Spark and put in place by renames, one per landed file.
    A retry with the same ``uploaded_at`` replaces its own files and adds none.  Where a
    month has several files, the second and later records of a name carry their number
    in the order of the files' paths.  Returns the names, relative to ``out``.
    """
    spark = manifest.sparkSession
    if uploaded_at is None:
        uploaded_at = spark.range(1).select(F.current_timestamp()).first()[0]     # one time for all names
    stamp = F.date_format(utc_ntz(F.lit(uploaded_at).cast("timestamp")), "yyyyMMdd'T'HHmmss'Z'")
    undated = F.concat(F.lit("ingestion_0000_00_gzip_"), stamp, F.lit(".json"))      # a file outside month folders
    log = ingestion_log(manifest, uploaded_at, **kwargs).withColumn("log_name", F.coalesce("log_name", undated))
    number = F.row_number().over(Window.partitionBy("log_name").orderBy("s3_key"))
    name = F.when(number == 1, F.col("log_name")).otherwise(
        F.concat(F.regexp_replace("log_name", r"\.json$", "_"), number.cast("string"), F.lit(".json")))
    folder = F.concat(F.lit("year="), F.coalesce(F.col("year").cast("string"), F.lit("0000")), F.lit("/month="),
                      F.coalesce(F.lpad(F.col("month").cast("string"), 2, "0"), F.lit("00")), F.lit("/"))
    fields = F.to_json(F.struct(*[c for c in log.columns if c != "log_name"]), {"ignoreNullFields": "false"})
    docs = log.select(F.concat(folder, name).alias("name"), fields.alias("value"))
    docs = docs.withColumn("document", F.sha2("name", 256))
    aside = f"{out.rstrip('/')}/_aside-{uuid.uuid4().hex[:8]}"
    p, fs = _filesystem(spark, aside)
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    try:
        docs.select("value", "document").repartition("document").write.partitionBy("document").text(aside)
        names = sorted((r.name, r.document) for r in docs.select("name", "document").collect())   # one per landed file
        for name, document in names:
            part = fs.globStatus(_filesystem(spark, f"{aside}/document={document}/part-*")[0])[0].getPath()
            target = _filesystem(spark, f"{out.rstrip('/')}/{name}")[0]
            fs.mkdirs(target.getParent())
            files.rename(part, target, over)
    finally:
        fs.delete(p, True)
    return [name for name, _ in names]


def _filesystem(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite", dynamic_overwrite: bool = False) -> None:
    """Materialise a model as parquet.

    A full rebuild is written beside the table and then put in its place, so a
    failed job leaves the old table.  With ``dynamic_overwrite`` and
    ``partition_by`` only the partitions present in ``df`` are replaced.
    """
    path, spark = path.rstrip("/"), df.sparkSession
    swap = mode == "overwrite" and not dynamic_overwrite
    w = df.write.mode(mode)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if not swap:
        with unsorted_folders(spark):
            w.parquet(path)
        return
    mark = uuid.uuid4().hex[:8]
    new, fs = _filesystem(spark, f"{path}.new-{mark}")
    with unsorted_folders(spark):
        w.parquet(f"{path}.new-{mark}")
    target, old = _filesystem(spark, path)[0], _filesystem(spark, f"{path}.old-{mark}")[0]
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(new, target):
        fs.rename(old, target)
        raise OSError(f"could not put the new table in place at {path}")
    fs.delete(old, True)
