"""Load contract over hand-made gzip CSV files (E1-E8) and the incremental load."""

import os
import zipfile

from pyspark.sql import functions as F

from conftest import csv_line, write_gz
from tarmac.sources.landing import read_raw
from tarmac.sources.schema import FILE_COLUMNS, RAW_COLUMNS
from tarmac.sources.files import file_manifest
from tarmac.streaming.incremental import (
    changed_files, load_counts, load_raw, read_loaded, read_rejects, reload_files,
)

BASE = {"Year": "2024", "Month": "1", "FlightDate": "2024-01-05", "Reporting_Airline": "AA",
        "Flight_Number_Reporting_Airline": "100", "Origin": "JFK", "Dest": "LAX"}


def land(tmp_path, lines, name="on_time_2024_01.csv.gz", month="01"):
    return write_gz(tmp_path / "landing" / "year=2024" / f"month={month}" / name, lines)


def test_quoting_nulls_ragged_e1_to_e5(spark, tmp_path):
    lines = [
        csv_line({**BASE, "OriginCityName": "New York, NY"}),                       # E1
        csv_line({**BASE, "Tail_Number": "NULL", "DestCityName": "", "Dest": "X"}),  # E2 unquoted
        '2024,,1,,,2024-01-06,AA,,,"NULL",101,,,,JFK,""\n',                        # E2 quoted + E3 short
        csv_line(["2024"] + [""] * 109 + ["extra1", "extra2"]),                     # E4 extra
        csv_line({**BASE, "OriginCityName": "Line one\nline two"}),                 # E5
    ]
    land(tmp_path, lines)
    rows = read_raw(spark, str(tmp_path / "landing"), loaded_at="2024-02-01 00:00:00").collect()
    assert len(rows) == 5
    assert len(rows[0]) == len(RAW_COLUMNS) == 112
    assert rows[0]["OriginCityName"] == "New York, NY"
    assert rows[1]["Tail_Number"] is None and rows[1]["DestCityName"] is None
    assert rows[2]["Tail_Number"] is None and rows[2]["OriginCityName"] is None
    assert rows[2]["Dest"] is None and rows[2]["Flight_Number_Reporting_Airline"] == "101"
    assert rows[3]["Year"] == "2024" and rows[3]["_TRAILING_EMPTY_COL"] is None
    assert rows[4]["OriginCityName"] == "Line one\nline two"
    assert {r["_SOURCE_FILE"] for r in rows} == {"year=2024/month=01/on_time_2024_01.csv.gz"}
    assert str(rows[0]["_LOAD_TIMESTAMP"]) == "2024-02-01 00:00:00"


def test_pattern_skips_other_files_e6(spark, tmp_path):
    land(tmp_path, [csv_line(BASE)])
    land(tmp_path, [csv_line(BASE)] * 3, name="other.csv.gz")
    zpath = tmp_path / "landing" / "year=2024" / "month=01" / "data.zip"
    with zipfile.ZipFile(zpath, "w") as z:
        z.writestr("x.csv", "a,b\n1,2\n")
    assert read_raw(spark, str(tmp_path / "landing")).count() == 1


def test_data_columns_win_over_folders_e8(spark, tmp_path):
    land(tmp_path, [csv_line(BASE)])
    r = read_raw(spark, str(tmp_path / "landing")).select("Year", "Month").first()
    assert (r.Year, r.Month) == ("2024", "1")


def test_month_selection(spark, tmp_path):
    land(tmp_path, [csv_line(BASE)], month="01")
    land(tmp_path, [csv_line({**BASE, "Month": "2"})] * 2, name="on_time_2024_02.csv.gz", month="02")
    df = read_raw(spark, str(tmp_path / "landing"), months=[(2024, 2)])
    assert [r.Month for r in df.collect()] == ["2", "2"]


def test_unparsable_rows_set_aside(spark, tmp_path):
    lines = [csv_line(BASE), '2024,1,"broken,1\n', csv_line({**BASE, "Dest": "SEA"})]
    land(tmp_path, lines)
    good, bad = read_raw(spark, str(tmp_path / "landing"), multiline=False, with_rejects=True)
    assert sorted(r.Dest for r in good.collect()) == ["LAX", "SEA"]
    assert bad.count() == 1


def test_incremental_load_exactly_once_e7(spark, tmp_path):
    root = str(tmp_path / "landing")
    land(tmp_path, [csv_line(BASE)] * 5)
    out, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    assert load_raw(spark, root, out, ckpt)["rows"] == 5
    assert load_raw(spark, root, out, ckpt)["rows"] == 0          # re-run: nothing new
    assert read_loaded(spark, out).count() == 5
    land(tmp_path, [csv_line({**BASE, "Month": "2"})] * 2, name="on_time_2024_02.csv.gz", month="02")
    assert load_raw(spark, root, out, ckpt)["rows"] == 2          # backfill / new month
    assert read_loaded(spark, out).count() == 7
    assert read_loaded(spark, out).columns == list(RAW_COLUMNS)


def test_incremental_load_with_quarantine(spark, tmp_path):
    root = str(tmp_path / "landing")
    land(tmp_path, [csv_line(BASE), '2024,1,"broken,1\n', csv_line(BASE)])
    out, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    told = load_raw(spark, root, out, ckpt, multiline=False)
    assert (told["rows"], told["rejected"]) == (2, 1)
    assert read_loaded(spark, out).count() == 2 and read_rejects(spark, out).count() == 1
    counts = load_counts(spark, out).first()
    assert (counts.parsed, counts.loaded, counts.rejected) == (3, 2, 1)


def test_raw_scan_prunes_and_pushes(spark, tmp_path):
    """Over the parquet raw table the carrier filter reaches the scan and only
    the needed columns are read."""
    land(tmp_path, [csv_line(BASE), csv_line({**BASE, "Reporting_Airline": "WN"})])
    out = str(tmp_path / "rawpq")
    read_raw(spark, str(tmp_path / "landing")).write.parquet(out)
    from tarmac.plans.models import stg_flights
    stg = stg_flights(spark.read.parquet(out)).select("carrier_code", "flight_date")
    plan = stg._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(Reporting_Airline" in plan
    assert "ReadSchema: struct<FlightDate:string,Reporting_Airline:string>" in plan
    assert [r.carrier_code for r in stg.collect()] == ["AA"]


def test_file_columns_are_positional():
    assert len(FILE_COLUMNS) == 110
    assert FILE_COLUMNS[-2] == "Div5TailNum" and FILE_COLUMNS[-1] == "_TRAILING_EMPTY_COL"
    assert os.path.basename(__file__).startswith("test_")


def test_backfill_in_bounded_batches(spark, tmp_path):
    root = str(tmp_path / "landing")
    for m in (1, 2, 3):
        land(tmp_path, [csv_line({**BASE, "Month": str(m)})] * m,
             name=f"on_time_2024_{m:02d}.csv.gz", month=f"{m:02d}")
    out, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    res = load_raw(spark, root, out, ckpt, max_files_per_trigger=1)
    assert (res["batches"], res["rows"], res["rejected"]) == (3, 6, 0)
    assert sorted(r.Month for r in read_loaded(spark, out).collect()) == ["1", "2", "2", "3", "3", "3"]


def test_failed_batch_is_replayed_without_duplicates(spark, tmp_path, monkeypatch):
    """A batch that fails is replayed on the next run into the same folder."""
    import pytest
    import tarmac.streaming.incremental as inc
    root = str(tmp_path / "landing")
    land(tmp_path, [csv_line(BASE)] * 4)
    out, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    real = inc._write_batch

    def failing(rows, out, batch):
        real(rows, out, batch)
        raise RuntimeError("simulated failure after the write")

    monkeypatch.setattr(inc, "_write_batch", failing)
    with pytest.raises(Exception):
        load_raw(spark, root, out, ckpt, multiline=False)
    monkeypatch.setattr(inc, "_write_batch", real)
    assert load_raw(spark, root, out, ckpt, multiline=False)["rows"] == 4   # replay
    assert read_loaded(spark, out).count() == 4


def test_old_files_and_all_depths_load(spark, tmp_path):
    root = tmp_path / "landing"
    land(tmp_path, [csv_line(BASE)] * 3)
    out, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    load_raw(spark, str(root), out, ckpt)
    old = land(tmp_path, [csv_line(BASE)] * 5, name="on_time_old.csv.gz", month="02")
    for path, n in ((old, 5), (root / "on_time_top.csv.gz", 2), (root / "a/b/c/on_time_deep.csv.gz", 7)):
        if path is not old:
            write_gz(path, [csv_line(BASE)] * n)
        os.utime(path, (1_600_000_000, 1_600_000_000))
    assert load_raw(spark, str(root), out, ckpt)["rows"] == 14
    assert read_loaded(spark, out).count() == 17


def test_changed_file_is_reloaded_once(spark, tmp_path):
    root = str(tmp_path / "landing")
    path = land(tmp_path, [csv_line(BASE)] * 2)
    out, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    load_raw(spark, root, out, ckpt)
    known = spark.createDataFrame(file_manifest(spark, root).collect())
    assert changed_files(spark, root, known).count() == 0
    write_gz(path, [csv_line(BASE)] * 5)
    changed = [r.path for r in changed_files(spark, root, known).collect()]
    assert len(changed) == 1
    assert reload_files(spark, root, out, changed)["rows"] == 5
    assert read_loaded(spark, out, reloads=True).count() == 5


def test_scan_does_not_depend_on_the_session(spark, tmp_path):
    root = str(tmp_path / "landing")
    land(tmp_path, [csv_line(BASE), '2024,1,"broken,1\n', csv_line(BASE)])
    keys = ("spark.sql.csv.parser.columnPruning.enabled", "spark.sql.session.timeZone")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "true")
        spark.conf.set(keys[1], "America/New_York")
        raw = read_raw(spark, root, multiline=False, loaded_at="2024-07-01 05:26:16")
        assert raw.count() == len(raw.collect()) == len(raw.select("Year").collect()) == 2
        assert str(raw.first()["_LOAD_TIMESTAMP"]) == "2024-07-01 09:26:16"     # UTC
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_month_selection_edges(spark, tmp_path):
    import pytest
    from tarmac.sources.landing import month_paths
    with pytest.raises(ValueError):
        month_paths(str(tmp_path), [(2024, 13)])
    assert month_paths("/x/", [(2024, 3)]) == ["/x/year=2024/month=03"]
    assert read_raw(spark, str(tmp_path), months=[]).count() == 0
