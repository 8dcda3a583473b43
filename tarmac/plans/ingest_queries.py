"""Registered queries that exercise the load path on files Spark writes from
the driver's tables: land as gzip CSV, scan back, incremental load, pending
files.  Each call works in a fresh folder under the shared checkpoint root."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.functions.casts import cast_fails
from tarmac.functions.constants import LANDING_PATH_REGEX
from tarmac.operators.bookkeeping import compression_report, load_report, pending_files
from tarmac.plans.build import FACT_PARTITION, build, partitioned_fact, rebuild_fact_months
from tarmac.plans.models import stg_flights
from tarmac.plans.modelset import ModelSet
from tarmac.session import scratch_path, unsorted_folders
from tarmac.sinks.files import LANDED_GLOB, land_csv_gz, write_log_documents, write_table
from tarmac.sources.files import file_manifest, inspect_csv
from tarmac.sources.fixture import fixture_raw, raw_flights_from_lineitem, read_table
from tarmac.sources.landing import CORRUPT_COL, landed_files, read_raw, relative_path
from tarmac.sources.records import load_result, read_lines, read_records, scan_records
from tarmac.sources.schema import FILE_COLUMNS, LOAD_TS_COL, SOURCE_FILE_COL
from tarmac.streaming.ledger import read_live, sync
from tarmac.streaming.incremental import load_counts, load_raw, read_loaded


def _fixture_text_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in (SOURCE_FILE_COL, LOAD_TS_COL)]


def _land(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    raw = fixture_raw(spark, sf_dir)
    root = scratch_path(spark, "landing")
    land_csv_gz(raw, root)
    return raw, root


def load_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture -> gzip CSV in year/month folders -> bulk scan back (text columns)."""
    raw, root = _land(spark, sf_dir)
    return read_raw(spark, root, pattern=LANDED_GLOB).select(*_fixture_text_columns(raw))


def load_incremental_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land once, run the exactly-once load twice: the table holds each row once."""
    raw, root = _land(spark, sf_dir)
    out, ckpt = scratch_path(spark, "raw"), scratch_path(spark, "raw-ckpt")
    load_raw(spark, root, out, ckpt, pattern=LANDED_GLOB)
    load_raw(spark, root, out, ckpt, pattern=LANDED_GLOB)
    return read_loaded(spark, out).select(*_fixture_text_columns(raw))


def load_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and load time per source file of the raw table."""
    return load_report(fixture_raw(spark, sf_dir))


def pending_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all months, load January..June, list the months whose files are
    still pending (manifest anti-join loaded source files)."""
    _, root = _land(spark, sf_dir)
    loaded = read_raw(spark, root, months=[(2024, m) for m in range(1, 7)], pattern=LANDED_GLOB)
    out = scratch_path(spark, "raw-h1")
    loaded.write.parquet(out)
    landed = (file_manifest(spark, root, LANDED_GLOB, with_hash=False)
              .withColumn("source_file", relative_path(F.col("path"), root)))
    done = spark.read.parquet(out).select(F.col(SOURCE_FILE_COL).alias("source_file"))
    todo = pending_files(landed, done, on=("source_file",))
    return todo.select("year", "month").distinct()


def _month() -> F.Column:
    return F.col("Month").cast("int")


def load_backfill_old_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: months from February on are loaded, then January arrives with file times a month
    older than theirs; the next run loads it too."""
    raw = fixture_raw(spark, sf_dir)
    root, out, ckpt = (scratch_path(spark, n) for n in ("landing", "raw", "raw-ckpt"))
    land_csv_gz(raw.where(_month() > 1), root)
    load_raw(spark, root, out, ckpt, pattern=LANDED_GLOB)
    land_csv_gz(raw.where(_month() == 1), root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(path(f"{root}/year=*/month=01/*")):
        old = status.getModificationTime() - 30 * 24 * 3600 * 1000
        fs.setTimes(status.getPath(), old, old)
    load_raw(spark, root, out, ckpt, pattern=LANDED_GLOB)
    return read_loaded(spark, out).select(*_fixture_text_columns(raw))


def load_all_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: files are found at any depth: in month folders, below them, and above."""
    raw = fixture_raw(spark, sf_dir)
    root, out, ckpt = (scratch_path(spark, n) for n in ("landing", "raw", "raw-ckpt"))
    land_csv_gz(raw.where(_month() <= 4), root)
    land_csv_gz(raw.where(_month().between(5, 8)), f"{root}/deeper/still")
    flat = raw.where(_month() > 8)
    _write_lines(flat, root, "append")
    load_raw(spark, root, out, ckpt, pattern=LANDED_GLOB)
    return read_loaded(spark, out).select(*_fixture_text_columns(raw))


def _fields(raw: DataFrame) -> list:
    have = set(raw.columns)
    quoted = [F.when(F.col(c).contains(","), F.concat(F.lit('"'), F.col(c), F.lit('"'))).otherwise(
        F.coalesce(F.col(c), F.lit(""))) if c in have else F.lit("") for c in FILE_COLUMNS]
    return quoted


def _write_lines(raw: DataFrame, root: str, mode: str = "overwrite", line=None) -> None:
    """Rows as text lines in gzip files right under ``root`` (each with a header line).

    A gzip file is one task when it is read, so none has more than 250,000 rows.
    """
    text = line if line is not None else F.concat_ws(",", *_fields(raw))
    lines = raw.select(text.alias("header"))
    (lines.write.mode(mode).option("maxRecordsPerFile", 250_000).option("header", "true").option("compression", "gzip")
     .option("quote", "\u0000").option("escapeQuotes", "false").option("sep", "\u0001").csv(root))


def _with_rejects(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Line number 7 of every order lands as a record with an unbalanced quote."""
    raw = raw_flights_from_lineitem(read_table(spark, sf_dir, "lineitem"), extra=["l_linenumber"])
    root = scratch_path(spark, "landing-bad")
    broken = F.concat(F.lit('2024,1,"'), F.col("Month"))
    _write_lines(raw, root, line=F.when(F.col("l_linenumber") == 7, broken).otherwise(
        F.concat_ws(",", *_fields(raw))))
    return raw, root


def _numbered_lines(raw: DataFrame, root: str, broken) -> None:
    """Each month's rows as one landed file, sorted by order and line number."""
    text = broken(F.concat_ws(",", *_fields(raw)))
    lines = raw.select(text.alias("line"), _month().alias("month"), "l_orderkey", "l_linenumber", "l_partkey")
    header = F.lit(",".join(FILE_COLUMNS))
    lines = lines.unionByName(lines.select("month").distinct().select(
        header.alias("line"), "month", *[F.lit(-1).alias(c) for c in ("l_orderkey", "l_linenumber", "l_partkey")]))
    (lines.repartition("month").sortWithinPartitions("month", "l_orderkey", "l_linenumber", "l_partkey")
     .select("line", "month").write.partitionBy("month").option("compression", "gzip").text(root))


def load_first_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per landed file what was loaded and where its first error is.

    Line number 7 of an order opens a quote that is never closed, line number 6 has text
    after a closing quote; both in the file's fourth field.
    """
    raw = raw_flights_from_lineitem(read_table(spark, sf_dir, "lineitem"),
                                    extra=["l_orderkey", "l_linenumber", "l_partkey"])
    root = scratch_path(spark, "landing-lines")
    number = F.col("l_linenumber")
    _numbered_lines(raw, root, lambda line: F.when(number == 7, F.concat(F.lit('2024,1,1,"'), "DayofMonth"))
                    .when(number == 6, F.concat(F.lit('2024,1,1,"5"'), "DayofMonth")).otherwise(line))
    found = load_result(scan_records(read_lines(spark, root, pattern="*.txt.gz")))
    return found.select(F.regexp_extract("file", r"month=(\d+)", 1).cast("int").alias("month"), "status", "rows_parsed",
                        "rows_loaded", "errors_seen", "first_error", "first_error_line", "first_error_character",
                        "first_error_column_name")


def load_quote_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that are left when every order's lines 6 and 7 break the quoting, and no others are lost."""
    raw = raw_flights_from_lineitem(read_table(spark, sf_dir, "lineitem"), extra=["l_linenumber"])
    root = scratch_path(spark, "landing-quotes")
    line, number = F.concat_ws(",", *_fields(raw)), F.col("l_linenumber")
    _write_lines(raw, root, line=F.when(number == 7, F.concat(F.lit('2024,1,"'), F.col("Month"))).when(
        number == 6, F.concat(F.lit('"2024"x,'), line)).otherwise(line))
    rows, _ = read_records(spark, root, pattern=LANDED_GLOB)
    return rows.select(*[c for c in _fixture_text_columns(raw) if c != "l_linenumber"])


def load_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: records parsed, loaded and rejected by the incremental load, over all its files."""
    _, root = _with_rejects(spark, sf_dir)
    out, ckpt = scratch_path(spark, "raw"), scratch_path(spark, "raw-ckpt")
    told = load_raw(spark, root, out, ckpt, pattern=LANDED_GLOB, multiline=False)
    return load_counts(spark, out).agg(
        F.sum("parsed").alias("parsed"), F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected")).select(
        "*", F.lit(told["rows"]).cast("long").alias("told_loaded"),
        F.lit(told["rejected"]).cast("long").alias("told_rejected"))


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records of each month the scan keeps and sets aside."""
    _, root = _with_rejects(spark, sf_dir)
    raw, rejects = read_raw(spark, root, pattern=LANDED_GLOB, multiline=False, with_rejects=True)
    good = raw.groupBy("Month").agg(F.count(F.lit(1)).alias("good"))
    bad = rejects.groupBy(F.regexp_extract(CORRUPT_COL, r"(\d+)$", 1).alias("Month")).agg(
        F.count(F.lit(1)).alias("bad"))
    return good.join(bad, "Month", "full").select(
        "Month", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"))


def load_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short records are padded with NULL, surplus fields dropped, nothing is lost."""
    raw = raw_flights_from_lineitem(read_table(spark, sf_dir, "lineitem"), extra=["l_linenumber"])
    root = scratch_path(spark, "landing-ragged")
    fields = _fields(raw)
    short = F.concat_ws(",", *fields[:7])
    long_ = F.concat_ws(",", *fields, F.lit("surplus"), F.lit("more"))
    _write_lines(raw, root, line=F.when(F.col("l_linenumber") % 2 == 0, short).otherwise(long_))
    got = read_raw(spark, root, pattern=LANDED_GLOB)
    return got.select("Year", "Month", "FlightDate", "Reporting_Airline", "Origin", "Dest")


def load_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only files of the landing pattern are read; plain CSV beside them is not."""
    raw = fixture_raw(spark, sf_dir)
    root = scratch_path(spark, "landing")
    land_csv_gz(raw.where(_month() <= 6), root)
    raw.where(_month() > 6).select(F.concat_ws(",", *_fields(raw)).alias("h")).write.mode("append").option(
        "header", "true").csv(f"{root}/plain")
    return read_raw(spark, root, pattern=LANDED_GLOB).select(*_fixture_text_columns(raw))


def load_path_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default pattern over whole paths: the objects whose folder names them are loaded, others not."""
    raw = fixture_raw(spark, sf_dir)
    root = scratch_path(spark, "landing")
    land_csv_gz(raw.where(_month() <= 4), root, source="on_time_2024_q1")
    land_csv_gz(raw.where(_month().between(5, 8)), root, source="other_2024")
    land_csv_gz(raw.where(_month() > 8), f"{root}/deep/on_time_2024/er", source="late")
    chosen = landed_files(spark, root).select(F.col("path").alias("_path"))
    rows = read_raw(spark, root, path_regex=LANDING_PATH_REGEX)
    # every row is from a file of the list
    return rows.join(chosen, rows[SOURCE_FILE_COL] == chosen["_path"], "left_semi").select(*_fixture_text_columns(raw))


def load_same_bytes_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4, K5: every month's files lie there under a second name too; each is loaded once.

    Then the first names of January to June are deleted: the second ones take over.
    """
    raw = fixture_raw(spark, sf_dir)
    root, base = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    land_csv_gz(raw, f"{root}/first")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs, conf = path(root).getFileSystem(spark._jsc.hadoopConfiguration()), spark._jsc.hadoopConfiguration()
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, path(f"{root}/first"), fs, path(f"{root}/second"), False, conf)
    places = (root, f"{base}/rows", f"{base}/checkpoint", f"{base}/files")
    told = sync(spark, *places, pattern=LANDED_GLOB)
    assert told["copies"] * 2 == told["new"]
    for month in range(1, 7):
        fs.delete(path(f"{root}/first/year=2024/month={month:02d}"), True)
    sync(spark, *places, pattern=LANDED_GLOB)
    return read_live(spark, f"{base}/rows", f"{base}/files").select(*_fixture_text_columns(raw))


def land_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: two objects hold rows of the same months; landing the first again adds nothing."""
    raw = raw_flights_from_lineitem(read_table(spark, sf_dir, "lineitem"), extra=["l_linenumber"])
    root = scratch_path(spark, "landing")
    early, late = raw.where("l_linenumber <= 3"), raw.where("l_linenumber > 3")
    for rows, name in ((early, "first"), (late, "second"), (early, "first")):
        land_csv_gz(rows, root, source=name)
    return read_raw(spark, root, pattern=LANDED_GLOB).select(
        *[c for c in _fixture_text_columns(raw) if c != "l_linenumber"])


def compression_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: the months' files before and after compression, each smaller, none missing."""
    raw = fixture_raw(spark, sf_dir)
    plain, root = scratch_path(spark, "plain"), scratch_path(spark, "landing")
    with unsorted_folders(spark):
        (raw.select(F.concat_ws(",", *_fields(raw)).alias("line"), _month().alias("month"))
         .write.partitionBy("month").text(plain))
    land_csv_gz(raw, root)
    per_month = [file_manifest(spark, p, "part-*", with_hash=False).groupBy(F.col("month").cast("string").alias("stem"))
                 .agg(F.sum("size").alias("size")) for p in (plain, root)]
    return compression_report(*per_month).select(
        F.col("stem").cast("int").alias("month"), (F.col("saved_pct") > 0).alias("smaller"),
        (F.col("saved_pct") == F.round((1 - F.col("gz_bytes") / F.col("csv_bytes")) * 100, 1)).alias("share_ok"))


def strict_cast_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that a strict cast refuses."""
    raw = raw_flights_from_lineitem(read_table(spark, sf_dir, "lineitem"), extra=["l_linenumber"])
    bad = F.col("l_linenumber") == 7
    texts = raw.select(
        F.when(bad, F.lit("1x")).otherwise(F.col("Distance")).alias("number"),
        F.when(bad, F.lit("2024-13-01")).otherwise(F.col("FlightDate")).alias("day"), "Month")
    return texts.groupBy("Month").agg(
        F.count_if(cast_fails("number", "int")).alias("bad_int"),
        F.count_if(cast_fails("number", "double")).alias("bad_double"),
        F.count_if(cast_fails("day", "date")).alias("bad_date"), F.count(F.lit(1)).alias("n"))


def fact_month_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month-partitioned fact after rebuilding three months equals a full build.

    The table first holds wrong months: March without its rows, April twice, and a
    May that the raw rows no longer have.  Some months are written ``'3.00'``.
    """
    raw = fixture_raw(spark, sf_dir).withColumn(
        "Month", F.when(F.col("DayofMonth") == "5", F.concat("Month", F.lit(".00"))).otherwise(F.col("Month")))
    month = F.month(F.to_date("FlightDate"))
    now = raw.where(month != 5)
    out = scratch_path(spark, "models")
    stale = raw.where(month != 3).unionByName(raw.where(month == 4))
    write_table(partitioned_fact(stg_flights(stale)), f"{out}/fact_flights", (FACT_PARTITION,))
    fact = rebuild_fact_months(spark, now, out, [(2024, 3), (2024, 4), (2024, 5)])
    return fact.drop(FACT_PARTITION)


def build_mart_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart layer alone, from core tables an earlier build left."""
    raw, out = fixture_raw(spark, sf_dir), scratch_path(spark, "models")
    build(spark, raw, out, layers=("staging", "core"), register_views=False)
    marts = build(spark, raw, out, layers=("mart",), register_views=False)
    return marts.table("mart_carrier_performance_monthly")


def mart_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: position of every row of the stored mart in the order it is written in."""
    m = ModelSet(spark, sf_dir)
    out = scratch_path(spark, "mart")
    m.mart_carrier_performance().write.parquet(out)
    at = F.struct(F.col("_metadata.file_name"), F.monotonically_increasing_id())
    rows = spark.read.parquet(out).withColumn("at", at)
    return rows.select("carrier_key", "year", "month_num",
                       F.row_number().over(Window.orderBy("at")).alias("position"))


def ingestion_log_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the fixture and build the ingestion log from the file manifest;
    compare each record's size, hash and names with the bytes of its file, read
    apart, and report the fixed fields per landed month."""
    from tarmac.sinks.files import ingestion_log
    _, root = _land(spark, sf_dir)
    log = ingestion_log(file_manifest(spark, root, LANDED_GLOB), "2024-07-01 09:26:16", aws_region="eu-west-1")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", LANDED_GLOB)
             .load(root).select(F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?/?", "").alias("s3_key"),
                                F.octet_length("content").alias("bytes"), F.sha2("content", 256).alias("sha")))
    return (log.join(files, "s3_key", "left")
               .select("pipeline_name", "source_system", "step", "year", "month", "status", "aws_region",
                       "uploaded_at_utc", "log_name", F.col("file_size_bytes").eqNullSafe(F.col("bytes")).alias("size_ok"),
                       F.col("file_sha256").eqNullSafe(F.col("sha")).alias("sha_ok"))
               .distinct())


def log_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the log's JSON files, one per landed file, written twice: their names and 13 fields read back.

    The documents of a month's files are one row if all are right.  One that is wrong, missing
    or too many adds a row.
    """
    _, root = _land(spark, sf_dir)
    manifest = file_manifest(spark, root, LANDED_GLOB)
    out = scratch_path(spark, "log")
    for _ in range(2):
        write_log_documents(manifest, out, "2024-07-01 09:26:16", aws_region="eu-west-1")
    docs = spark.read.text(f"{out}/year=*/month=*/*.json", wholetext=True).select(
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("document"), F.col("value").alias("text"))
    schema = ("pipeline_name string, source_system string, step string, year int, month int, s3_bucket string, "
              "s3_key string, aws_region string, filename string, file_size_bytes long, file_sha256 string, "
              "uploaded_at_utc string, status string")
    docs = docs.withColumn("r", F.from_json("text", schema))
    keys = F.json_object_keys("text")
    at = F.row_number().over(Window.partitionBy("year", "month").orderBy("path"))
    sizes = manifest.select(F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?/?", "").alias("k"),
                            F.col("size").alias("bytes"), F.col("sha256").alias("sha"),
                            F.when(at == 1, "Z.json").otherwise(F.concat(F.lit("Z_"), at, F.lit(".json"))).alias("end"))
    docs = docs.join(sizes, F.col("r.s3_key") == F.col("k"), "full")
    # the number of a month's later file goes from its document's name if it is the right one
    document = F.when(F.endswith("document", "end"), F.regexp_replace("document", r"Z(_\d+)?\.json$", "Z.json"))
    return docs.select(
        F.coalesce(document, "document").alias("document"), F.array_join(keys, " ").alias("fields"), "r.pipeline_name",
        "r.source_system", "r.step", "r.year", "r.month", "r.aws_region", "r.uploaded_at_utc", "r.status",
        F.col("r.file_size_bytes").eqNullSafe(F.col("bytes")).alias("size_ok"),
        F.col("r.file_sha256").eqNullSafe(F.col("sha")).alias("sha_ok"),
        F.col("r.filename").eqNullSafe(F.element_at(F.split("r.s3_key", "/"), -1)).alias("name_ok")).distinct()


def inspect_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, records, columns, names and the cut first line of each month's file."""
    raw = raw_flights_from_lineitem(read_table(spark, sf_dir, "lineitem"),
                                    extra=["l_orderkey", "l_linenumber", "l_partkey"])
    root = scratch_path(spark, "inspect")
    _numbered_lines(raw, root, lambda line: line)
    out = None
    for month in range(1, 13):
        stats, preview = inspect_csv(spark, f"{root}/month={month}", n=1)
        part = stats.join(preview, how="full").select(
            F.lit(month).alias("month"), "n_lines", "n_records", "n_columns",
            F.array_join("first_columns", " ").alias("first_columns"),
            F.array_join("last_columns", " ").alias("last_columns"),
            F.length("line").alias("shown"), F.endswith("line", F.lit("...")).alias("cut"),
            F.startswith("line", F.lit(f"2024,{(month + 2) // 3},{month},")).alias("first_line"))
        out = part if out is None else out.unionByName(part)
    return out
