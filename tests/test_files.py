"""Manifests, compression report, ingestion log, CSV inspection (K4-K9)."""

import gzip
import hashlib
import json
import os

from pyspark.sql import functions as F

from conftest import csv_line
from tarmac.operators.bookkeeping import compression_report, file_stem, load_report, load_total, pending_files
from tarmac.sinks.files import ingestion_log, land_csv_gz, write_ingestion_log, LANDED_GLOB
from tarmac.sources.files import file_manifest, inspect_csv
from tarmac.sources.landing import read_raw
from helpers_raw import raw_df

ROW = {"Year": "2024", "Month": "1", "Reporting_Airline": "AA", "OriginCityName": "New York, NY"}


def make_csv(path, n, long_tail=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write("Year,Month,Reporting_Airline,OriginCityName" + (",X" * 106) + "\n")
        for i in range(n):
            f.write(csv_line({**ROW, "DayofMonth": str(i)}) if not long_tail else "z" * 250 + "\n")


def test_manifest_hash_and_compression(spark, tmp_path):
    src = tmp_path / "extracted" / "on_time_2024_01.csv"
    make_csv(str(src), 200)
    gz = tmp_path / "landing" / "year=2024" / "month=01" / "on_time_2024_01.csv.gz"
    os.makedirs(gz.parent)
    with open(src, "rb") as fi, gzip.open(gz, "wb") as fo:
        fo.write(fi.read())
    before = file_manifest(spark, str(tmp_path / "extracted"), "*.csv").withColumn("stem", file_stem())
    after = file_manifest(spark, str(tmp_path / "landing"), "*.csv.gz").withColumn("stem", file_stem())
    a = after.first()
    assert a.sha256 == hashlib.sha256(gz.read_bytes()).hexdigest()
    assert a.size == gz.stat().st_size and (a.year, a.month) == (2024, 1)
    rep = compression_report(before, after).first()
    expect = round((1 - gz.stat().st_size / src.stat().st_size) * 100, 1)
    assert rep.stem == "on_time_2024_01" and rep.saved_pct == expect


def test_ingestion_log_fields(spark, tmp_path):
    gz = tmp_path / "landing" / "year=2024" / "month=03" / "on_time_2024_03.csv.gz"
    os.makedirs(gz.parent)
    gz.write_bytes(gzip.compress(b"a,b\n"))
    man = file_manifest(spark, str(tmp_path / "landing"))
    log = ingestion_log(man, uploaded_at="2024-04-01 12:00:00")
    assert len(log.columns) == 14 and log.columns[-1] == "log_name"      # 13 fields and the file's name
    r = log.first()
    assert (r.year, r.month, r.filename, r.status) == (2024, 3, "on_time_2024_03.csv.gz", "SUCCESS")
    assert r.uploaded_at_utc == "2024-04-01T12:00:00+00:00" and r.file_size_bytes == gz.stat().st_size
    out = str(tmp_path / "logs")
    write_ingestion_log(man, out, uploaded_at="2024-04-01 12:00:00")
    files = [os.path.join(d, f) for d, _, fs in os.walk(out) for f in fs if f.endswith(".json")]
    rec = json.loads(open(files[0]).readline())
    assert rec["pipeline_name"] == "flights_ingestion" and "aws_region" in rec and rec["file_sha256"] == r.file_sha256


def test_inspect_csv(spark, tmp_path):
    p = tmp_path / "x.csv"
    make_csv(str(p), 5)
    stats, preview = inspect_csv(spark, str(p), n=3)
    s = stats.first()
    assert s.n_lines == 5 and s.n_records == 5 and s.n_columns == 110
    assert s.first_columns[:3] == ["Year", "Month", "Reporting_Airline"] and len(s.last_columns) == 5
    lines = [r.line for r in preview.collect()]
    assert len(lines) == 3 and lines[0].startswith("2024,,1,0,")
    q = tmp_path / "long.csv"
    make_csv(str(q), 2, long_tail=True)
    assert all(r.line.endswith("...") and len(r.line) == 203 for r in inspect_csv(spark, str(q))[1].collect())


def test_land_then_pending_and_report(spark, tmp_path):
    raw = raw_df(spark, [{}, {"Month": "2", "FlightDate": "2024-02-01"}])
    root = str(tmp_path / "landing")
    land_csv_gz(raw, root)
    loaded = read_raw(spark, root, months=[(2024, 1)], pattern=LANDED_GLOB)
    rep = load_report(loaded)
    assert load_total(rep).first().total_rows == 1
    man = file_manifest(spark, root, LANDED_GLOB).withColumn("source_file", F.regexp_replace("path", ".*/landing/", ""))
    todo = pending_files(man, rep, on=("source_file",)).collect()
    assert [(r.year, r.month) for r in todo] == [(2024, 2)]


def test_dynamic_partition_overwrite(spark, tmp_path):
    from tarmac.sinks.files import write_table
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "m int, v string")
    write_table(df, out, ["m"])
    write_table(spark.createDataFrame([(2, "c")], "m int, v string"), out, ["m"], dynamic_overwrite=True)
    assert sorted((r.m, r.v) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "c")]


def test_ingestion_log_dag_variant(spark, tmp_path):
    gz = tmp_path / "landing" / "year=2024" / "month=02" / "on_time_2024_02.csv.gz"
    os.makedirs(gz.parent)
    gz.write_bytes(gzip.compress(b"a,b\n"))
    log = ingestion_log(file_manifest(spark, str(tmp_path / "landing")), variant="dag")
    assert log.columns == ["pipeline_name", "year", "month", "s3_key", "file_size_bytes",
                           "file_sha256", "uploaded_at_utc", "status", "log_name"]
    assert log.first().pipeline_name == "flights_scheduled"
    named = ingestion_log(file_manifest(spark, str(tmp_path / "landing")), variant="dag", pipeline_name="own_label")
    assert named.first().pipeline_name == "own_label"


def test_inspect_counts_records_apart_from_lines(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text(",".join(["h"] * 110) + "\n" + csv_line({**ROW, "OriginCityName": "two\nlines"}))
    s = inspect_csv(spark, str(p))[0].first()
    assert (s.n_lines, s.n_records) == (2, 1)


def test_pending_by_hash_catches_rewritten_file(spark, tmp_path):
    f = tmp_path / "landing" / "year=2024" / "month=01" / "on_time_2024_01.csv.gz"
    os.makedirs(f.parent)
    f.write_bytes(gzip.compress(b"v1\n"))
    root = str(tmp_path / "landing")
    loaded = file_manifest(spark, root).collect()           # what the last load saw
    f.write_bytes(gzip.compress(b"v2 rewritten\n"))          # same path, new content
    now = file_manifest(spark, root)
    seen = spark.createDataFrame([(r.path, r.sha256) for r in loaded], "path string, sha256 string")
    assert pending_files(now, seen, on=("path",)).count() == 0
    assert pending_files(now, seen, on=("path", "sha256")).count() == 1


def test_landing_skips_objects_not_months(spark, tmp_path):
    raw = raw_df(spark, [{}, {"Month": "2", "FlightDate": "2024-02-01"}])
    root = str(tmp_path / "landing")
    assert land_csv_gz(raw.where("Month = '1'"), root, source="a")
    assert not land_csv_gz(raw.where("Month = '1'"), root, source="a")    # the object has landed
    assert land_csv_gz(raw, root, source="b")                             # late January rows are kept
    months = sorted(r.Month for r in read_raw(spark, root, pattern=LANDED_GLOB).collect())
    assert months == ["1", "1", "2"]


def test_landing_rows_without_a_month(spark, tmp_path):
    from tarmac.sinks.files import landed_months
    root = str(tmp_path / "landing")
    land_csv_gz(raw_df(spark, [{}, {"Year": None}]), root)
    land_csv_gz(raw_df(spark, [{}]), root)
    assert landed_months(spark, root) == [(0, 1), (2024, 1)]
    assert read_raw(spark, root, pattern=LANDED_GLOB).count() == 3


def test_landing_file_count_follows_the_data(spark, tmp_path):
    root = str(tmp_path / "landing")
    rows = raw_df(spark, [{"Month": str(m)} for m in (1, 2, 3)] * 40).repartition(16)
    land_csv_gz(rows, root)
    assert file_manifest(spark, root, LANDED_GLOB, with_hash=False).count() == 3


def test_failed_rebuild_leaves_the_table(spark, tmp_path):
    import pytest
    from tarmac.sinks.files import write_table
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a")], "m int, v string")
    write_table(df, out)
    with pytest.raises(Exception):
        write_table(df.withColumn("v", F.raise_error(F.lit("no")).cast("string")), out)
    write_table(df.withColumn("v", F.lit("b")), out)
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(1, "b")]
