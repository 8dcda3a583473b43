"""What bounds the memory, shuffle and time of a load: sizes of tasks and files, and their settings."""

import glob

from pyspark.sql import functions as F

from tarmac import session
from tarmac.plans import ingest_queries as Q
from tarmac.sinks.files import LANDED_GLOB, land_csv_gz
from tarmac.sources import fixture
from tarmac.sources.landing import read_raw
from tarmac.streaming.incremental import load_raw
from tests.conftest import csv_line, write_gz


def test_a_load_task_takes_few_gzip_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "GZIP_TASK", 1)
    for i in range(24):
        write_gz(str(tmp_path / f"in/{i}.csv.gz"), [csv_line({"FlightDate": "2024-01-05"})])
    told = load_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"), str(tmp_path / "ckpt"), pattern=LANDED_GLOB)
    assert told["rows"] == 24
    assert len(glob.glob(f"{tmp_path}/raw/load_batch=*/*/*/part-*")) == 24     # one task a file


def test_landed_texts_come_back_and_settings_are_left(spark, tmp_path):
    texts = ["a,b", 'q"q', '"', " lead", "x\ny", "trail ", "\\", "é", "x" * 5000, "", None]
    df = spark.createDataFrame([("2024", "1", t) for t in texts], "Year string, Month string, Tail_Number string")
    names = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
             "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(n) for n in names]
    land_csv_gz(df, str(tmp_path / "land"))
    assert [spark.conf.get(n) for n in names] == before
    got = [r[0] for r in read_raw(spark, str(tmp_path / "land"), pattern=LANDED_GLOB).select("Tail_Number").collect()]
    # outer blanks went before, too, when the file was written
    assert sorted(t or "" for t in got) == sorted((t or "").strip(" ") for t in texts)


def test_lines_are_split_into_files(spark, tmp_path):
    raw = spark.range(250_001, numPartitions=1).select(F.col("id").cast("string").alias("Year"))
    Q._write_lines(raw, str(tmp_path / "lines"))
    assert len(glob.glob(f"{tmp_path}/lines/part-*")) == 2
    assert read_raw(spark, str(tmp_path / "lines"), pattern=LANDED_GLOB).select("Year").distinct().count() == 250_001


def test_wide_rows_get_the_method_limit_unless_the_session_has_its_own(spark):
    line = spark.range(1).select(*[F.lit(1).alias(c) for c in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice")],
        F.lit("2024-01-01").alias("l_shipdate"))
    before = spark.conf.get(session.HUGE_METHOD)
    try:
        for given, wanted in (("65535", "8000"), ("9000", "9000")):
            spark.conf.set(session.HUGE_METHOD, given)
            fixture.raw_flights_from_lineitem(line)
            assert spark.conf.get(session.HUGE_METHOD) == wanted
    finally:
        spark.conf.set(session.HUGE_METHOD, before)


def test_lines_are_not_shuffled_to_find_their_file(spark, tmp_path):
    from tarmac.sources.records import read_lines, scan_records

    write_gz(str(tmp_path / "a.csv.gz"), [csv_line({"Year": "2024"})] * 3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = scan_records(read_lines(spark, str(tmp_path), pattern=LANDED_GLOB), multiline=False).records
        plan = records._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and records.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_load_of_month_folders_keeps_files_open(spark, tmp_path):
    lines = [csv_line({"FlightDate": "2024-01-05"})] * 3 + ['2024,1,"x\n']
    write_gz(str(tmp_path / "in/year=2024/month=01/a.csv.gz"), lines)
    write_gz(str(tmp_path / "mixed/a.csv.gz"), lines)
    name, told = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(name)
    from tarmac.streaming import incremental as I
    write = I._write_batch

    def probe(rows, out, batch):
        told.append(rows.sparkSession.conf.get(name))
        return write(rows, out, batch)

    I._write_batch = probe
    try:
        for folder in ("in", "mixed"):
            got = load_raw(spark, str(tmp_path / folder), str(tmp_path / f"raw-{folder}"), str(tmp_path / f"ckpt-{folder}"),
                           pattern=LANDED_GLOB, multiline=False)
            assert (got["rows"], got["rejected"]) == (3, 1)
    finally:
        I._write_batch = write
    assert told == [str(session.LOAD_WRITERS), "0"]
    assert spark.conf.get(name) == before
