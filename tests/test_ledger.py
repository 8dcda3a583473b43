"""The file ledger, month refresh and the key ledger: crashes, changes, plans."""

import gzip
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import csv_line, write_gz
from helpers_raw import DEFAULT
from tarmac.operators.key_ledger import KeyLedger
from tarmac.plans import build as B
from tarmac.plans import models as M
from tarmac.sinks.versions import VersionedTable
from tarmac.sources.fixture import fixture_raw
from tarmac.streaming import ledger as L

SF001 = "/root/testdata/sf0.001"


class Landing:
    def __init__(self, spark, base):
        self.spark, self.root = spark, str(base / "landing")
        self.out, self.ckpt, self.ledger = (str(base / n) for n in ("raw", "ckpt", "ledger"))

    def put(self, month, days, name=None):
        path = f"{self.root}/year=2024/month={month:02d}/{name or f'on_time_2024_{month:02d}'}.csv.gz"
        return write_gz(path, [csv_line({**DEFAULT, "Month": str(month), "FlightDate": f"2024-{month:02d}-{d:02d}"})
                               for d in days])

    def sync(self):
        return L.sync(self.spark, self.root, self.out, self.ckpt, self.ledger)

    def dates(self, months=None):
        live = L.read_live(self.spark, self.out, self.ledger, months)
        return sorted(r.FlightDate for r in live.select("FlightDate").collect())

    def files(self):
        return {os.path.basename(r.path): (r.version, r.status, r.n_rows, sorted(r.months))
                for r in L.read_ledger(self.spark, self.ledger).orderBy("version").collect()}


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_changed_emptied_touched_deleted_and_returned_files(spark, landing):
    jan, feb, mar = (landing.put(m, days) for m, days in ((1, [1, 2]), (2, [3]), (3, [4, 5])))
    told = landing.sync()
    assert (told["rows"], told["new"], told["replaced"], told["deleted"]) == (5, 3, 0, 0)
    marks = L.month_marks(L.read_ledger(spark, landing.ledger))
    assert sorted(marks) == [202401, 202402, 202403]
    version = L.ledger_table(spark, landing.ledger).versions()[-1]
    assert landing.sync()["rows"] == 0 and L.ledger_table(spark, landing.ledger).versions()[-1] == version

    landing.put(1, [7])                                       # other content
    write_gz(feb, [])                                         # a header only
    os.utime(mar, (1_600_000_000, 1_600_000_000))             # the same bytes at another time
    told = landing.sync()
    assert (told["rows"], told["new"], told["replaced"], told["deleted"]) == (1, 0, 2, 0)
    assert landing.dates() == ["2024-01-07", "2024-03-04", "2024-03-05"]
    assert landing.files()["on_time_2024_03.csv.gz"] == (1, "live", 2, [202403])
    after = L.month_marks(L.read_ledger(spark, landing.ledger))
    assert after[202403] == marks[202403] and after[202401] != marks[202401] and 202402 not in after

    kept = gzip.decompress(open(mar, "rb").read())
    os.remove(mar)
    assert landing.sync()["deleted"] == 1 and landing.dates() == ["2024-01-07"]
    with open(mar, "wb") as f:                                # back under its old name
        f.write(gzip.compress(kept))
    assert landing.sync()["rows"] == 2
    assert landing.dates() == ["2024-01-07", "2024-03-04", "2024-03-05"]
    assert landing.files()["on_time_2024_03.csv.gz"] == (2, "live", 2, [202403])
    assert landing.dates([202403]) == ["2024-03-04", "2024-03-05"]
    history = {os.path.basename(r.path): (r.versions, r.status, r.n_rows)
               for r in L.load_history(L.read_ledger(spark, landing.ledger)).collect()}
    assert history["on_time_2024_01.csv.gz"] == (2, "live", 1) and history["on_time_2024_02.csv.gz"] == (2, "live", 0)


def test_a_load_that_died_before_the_ledger_is_entered_later(spark, landing, monkeypatch):
    landing.put(1, [1, 2])
    real = VersionedTable.commit
    monkeypatch.setattr(VersionedTable, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        landing.sync()
    assert L.read_live(spark, landing.out, landing.ledger).count() == 0       # loaded, but not entered
    monkeypatch.setattr(VersionedTable, "commit", real)
    told = landing.sync()
    assert told["rows"] == 0 and landing.dates() == ["2024-01-01", "2024-01-02"]

    landing.put(1, [9])
    monkeypatch.setattr(VersionedTable, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        landing.sync()                                                        # reloaded, but not entered
    assert landing.dates() == ["2024-01-01", "2024-01-02"]
    monkeypatch.setattr(VersionedTable, "commit", real)
    assert landing.sync()["replaced"] == 1 and landing.dates() == ["2024-01-09"]
    assert sum(n.startswith("load_batch=") for n in os.listdir(landing.out)) == 2   # the orphan is gone


def test_names_with_spaces_and_empty_landing(spark, landing):
    os.makedirs(landing.root)
    assert landing.sync()["new"] == 0 and landing.dates() == []
    landing.put(1, [1], "my on_time_ file+%")
    landing.sync()
    landing.put(1, [2], "my on_time_ file+%")
    assert landing.sync()["replaced"] == 1 and landing.dates() == ["2024-01-02"]



def test_load_by_the_quote_grammar(spark, landing):
    good = csv_line({**DEFAULT, "OriginCityName": "two\nlines, NY"})
    path = f"{landing.root}/on_time_x.csv.gz"
    write_gz(path, [good, '2024,1,"open\n', good, '2024,"abc"x\n', good])
    sync = lambda: L.sync(spark, landing.root, landing.out, landing.ckpt, landing.ledger, strict_quotes=True)
    told = sync()
    assert (told["rows"], told["rejected"]) == (3, 2)
    live = L.read_live(spark, landing.out, landing.ledger)
    assert {r.OriginCityName for r in live.collect()} == {"two\nlines, NY"}
    bad = L.read_live(spark, landing.out, landing.ledger, rejects=True)
    assert sorted(r._corrupt_record for r in bad.collect()) == ['2024,"abc"x', '2024,1,"open']
    write_gz(path, [good, '"2024"x\n'])
    told = sync()
    assert (told["rows"], told["rejected"], told["replaced"]) == (1, 1, 1)
    assert landing.files()["on_time_x.csv.gz"] == (2, "live", 1, [202401]) and len(landing.dates()) == 1


# ---------------------------------------------------------------- months

def test_only_touched_months_are_read(spark, tmp_path):
    raw = fixture_raw(spark, SF001)
    key = F.col("Year").cast("int") * 100 + F.col("Month").cast("int")
    marks = {202400 + m: "a" for m in range(1, 13)}
    fact, _ = B.refresh_fact(spark, str(tmp_path), lambda keys: raw.where(key.isin(keys)), marks, "s")
    days, first = B.refresh_day_sums(spark, str(tmp_path), fact)
    assert len(first) == 12
    asked = []
    real = VersionedTable.read

    def reading(self, version=None, parts=None):
        df = real(self, version, parts)
        if self.path == fact.path:
            asked.append(sorted(set(re.findall(r"flight_month_key=(\d+)", " ".join(df.inputFiles())))))
        return df

    VersionedTable.read = reading
    try:
        fact, changed = B.refresh_fact(spark, str(tmp_path), lambda keys: raw.where(key.isin(keys)),
                                       marks | {202403: "b"}, "s")
        days, again = B.refresh_day_sums(spark, str(tmp_path), fact)
    finally:
        VersionedTable.read = real
    assert changed == again == ["flight_month_key=202403"] and asked == [["202403"]]
    stg = M.stg_flights(raw)
    want = M.carrier_month_stats(M.fact_flights(stg), M.dim_carrier(stg), M.dim_date(stg))
    got = M.stats_from_days(days.read(), M.dim_carrier(stg), M.dim_date(stg))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    other, rebuilt = B.refresh_fact(spark, str(tmp_path), lambda keys: raw.where(key.isin(keys)), marks, "other options")
    assert len(rebuilt) == 12                                  # staged by other options: all of it


def test_plain_fact_is_taken_over(spark, tmp_path):
    raw = fixture_raw(spark, SF001)
    table = VersionedTable(spark, str(tmp_path / "fact_flights"))
    table.commit(M.fact_flights(M.stg_flights(raw)))
    assert not B.month_layout(spark, table.path)
    key = F.col("Year").cast("int") * 100 + F.col("Month").cast("int")
    fact, folders = B.refresh_fact(spark, str(tmp_path), lambda keys: raw.where(key.isin(keys)),
                                   {202400 + m: "a" for m in range(1, 13)}, "")
    assert len(folders) == 12 and fact.read().count() == 3590


# ---------------------------------------------------------------- keys

@pytest.fixture
def keys(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    ledger = KeyLedger(spark, str(tmp_path / "it's hashes"), "k", "m", buckets=4)
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, m int")
    table.commit(frame(("a", 1), ("b", 1), ("b", 1), ("c", 2), (None, 2), (None, 2), ("d", None)), ["m"])
    return table, ledger, frame


def test_key_ledger_finds_duplicates_between_months(spark, keys):
    table, ledger, frame = keys
    assert len(ledger.refresh(table)) == 3
    found = lambda parts=None: sorted(map(tuple, ledger.duplicates(table, parts).collect()))
    assert found() == [("b", 2)]
    table.commit(frame(("c", 3), ("e", 3), ("d", 3)), ["m"], ["m=3"])
    assert ledger.refresh(table) == ["m=3"] and ledger.refresh(table) == []
    assert found() == [("b", 2), ("c", 2), ("d", 2)] and found(["m=3"]) == [("c", 2), ("d", 2)]
    assert found(["m=__HIVE_DEFAULT_PARTITION__"]) == [("d", 2)]
    assert tuple(ledger.check(table, "t").first()) == ("t", "k", "unique", 3)
    table.commit(frame(("x", 1)), ["m"], ["m=1", "m=3"])       # months 1 and 3 rebuilt: nothing is left
    ledger.refresh(table)
    assert found() == []


def test_key_ledger_moves_no_stored_hash(spark, keys):
    table, ledger, frame = keys
    ledger.refresh(table)
    table.commit(frame(("c", 3)), ["m"], ["m=3"])
    ledger.refresh(table)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for parts in (None, ["m=3"]):
            plan = ledger.candidates(parts)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and plan.count("Bucketed: true") == (1 if parts is None else 2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_ledger_settles_hash_clashes_on_the_keys(spark, keys, monkeypatch):
    table, ledger, frame = keys
    monkeypatch.setattr(KeyLedger, "_hash", lambda self: F.lit(7).cast("long").alias("h"))
    ledger.refresh(table)
    assert ledger.candidates().count() == 1
    assert sorted(map(tuple, ledger.duplicates(table).collect())) == [("b", 2)]


# ---------------------------------------------------------------- contents, paths, documents

def test_the_same_bytes_count_once(spark, landing):
    first = landing.put(1, [1, 2])
    body = open(first, "rb").read()
    second, third = (f"{landing.root}/copies/on_time_{n}.csv.gz" for n in "bc")
    os.makedirs(os.path.dirname(second))
    for path in (second, third):
        with open(path, "wb") as f:
            f.write(body)
    told = landing.sync()
    assert (told["new"], told["copies"]) == (3, 2) and landing.dates() == ["2024-01-01", "2024-01-02"]
    marks = L.month_marks(L.read_ledger(spark, landing.ledger))
    assert marks[202401].startswith("1:")
    live = [n for n, f in landing.files().items() if f[1] == "live"]
    assert live == ["on_time_b.csv.gz"]                        # the first by its path
    os.remove(second)
    assert landing.sync()["deleted"] == 1
    assert landing.dates() == ["2024-01-01", "2024-01-02"]     # another copy takes over
    assert landing.files()["on_time_c.csv.gz"][1] == "live"
    write_gz(third, [csv_line({**DEFAULT, "FlightDate": "2024-01-09"})])
    landing.sync()
    assert landing.dates() == ["2024-01-01", "2024-01-02", "2024-01-09"]      # no copy any more


def test_path_regex_opens_no_other_file(spark, tmp_path):
    from tarmac.sources.landing import landed_files, read_raw
    root = str(tmp_path / "l")
    good = write_gz(f"{root}/on_time_x/a.csv.gz", [csv_line(DEFAULT)])
    write_gz(f"{root}/other/b.csv.gz", [csv_line(DEFAULT)])
    write_gz(f"{root}/other/on_time_c.csv.gz.bak", [csv_line(DEFAULT)])
    with open(f"{root}/other/on_time_broken.csv.gz.x", "w") as f:
        f.write("not gzip")
    rows = read_raw(spark, root, path_regex=r".*on_time_.*\.csv\.gz")
    assert [r._SOURCE_FILE for r in rows.collect()] == ["on_time_x/a.csv.gz"]
    assert [(r.path, r.size) for r in landed_files(spark, root).collect()] == [
        ("on_time_x/a.csv.gz", os.path.getsize(good))]
    assert read_raw(spark, root, path_regex="nothing").count() == 0


def test_log_documents_of_one_month_and_a_retry(spark, tmp_path):
    import json
    from tarmac.sinks.files import write_log_documents
    from tarmac.sources.files import file_manifest
    for n in "ab":
        write_gz(str(tmp_path / f"in/year=2024/month=03/on_time_{n}.csv.gz"), [csv_line(DEFAULT)])
    write_gz(str(tmp_path / "in/on_time_c.csv.gz"), [])
    out = str(tmp_path / "log")
    manifest = file_manifest(spark, str(tmp_path / "in"))
    names = write_log_documents(manifest, out, "2024-04-01 12:00:00")
    assert names == write_log_documents(manifest, out, "2024-04-01 12:00:00")
    assert [n.split("/")[-1] for n in names if "month=03" in n] == [
        "ingestion_2024_03_gzip_20240401T120000Z.json", "ingestion_2024_03_gzip_20240401T120000Z_2.json"]
    assert len(names) == 3
    found = sorted(os.path.relpath(os.path.join(d, f), out) for d, _, fs in os.walk(out) for f in fs if f.endswith(".json"))
    assert found == sorted(names) and not [d for d in os.listdir(out) if d.startswith("_aside")]
    doc = json.loads(open(f"{out}/{names[0]}").read())
    assert len(doc) == 13 and "aws_region" in doc and doc["aws_region"] is None


def test_log_documents_query_has_every_file_of_a_month(spark, tmp_path, monkeypatch):
    import functools
    import glob
    import json
    import shutil
    from tarmac.plans import ingest_queries as Q
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: f"{tmp_path}/{case}/{name}")
    monkeypatch.setattr(Q, "land_csv_gz", functools.partial(Q.land_csv_gz, max_records_per_file=2))
    put = Q.write_log_documents

    def write(manifest, out, *args, **kwargs):
        names = put(manifest, out, *args, **kwargs)
        second = f"{out}/year=2024/month=01/ingestion_2024_01_gzip_20240701T092616Z_2.json"
        if case == "lost":
            os.remove(second)
        if case == "twice":
            shutil.copy(second, second.replace("Z_2.json", "Z_20.json"))
        return names

    monkeypatch.setattr(Q, "write_log_documents", write)
    # 7 rows in January, 5 in February
    spark.range(12, numPartitions=1).selectExpr("id * 5 AS l_orderkey", "'2024-01-01' AS l_shipdate", *[f"1 AS {c}" for c in (
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice")]).write.parquet(
            f"{tmp_path}/lineitem.parquet")
    right = [(f"ingestion_2024_0{m}_gzip_20240701T092616Z.json", m, True, True, True) for m in (1, 2)]
    found = {}
    for case in ("whole", "lost", "twice"):
        rows = Q.log_documents(spark, str(tmp_path)).collect()
        found[case] = [(r.document, r.month, r.size_ok, r.sha_ok, r.name_ok) for r in rows]
        assert set(right) <= set(found[case])
        landed = glob.glob(f"{tmp_path}/{case}/landing/*/*/*.csv.gz")
        assert len(landed) > 2
        if case == "whole":
            docs = [json.loads(open(f).read()) for f in glob.glob(f"{tmp_path}/whole/log/*/*/*.json")]
            assert sorted("/" + d["s3_key"] for d in docs) == sorted(landed)
    assert sorted(found["whole"]) == right
    assert [r for r in found["lost"] if r not in right] == [(None, None, False, False, True)]
    assert [r for r in found["twice"] if r not in right] == [
        ("ingestion_2024_01_gzip_20240701T092616Z_20.json", 1, True, True, True)]
