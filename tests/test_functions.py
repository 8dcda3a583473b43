"""Column functions: casts, time of day, flags, keys, regions, percentages."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tarmac.functions import casts as X
from tarmac.functions.scalar import census_region, pct, pct_of, surrogate_key, truncate_text


def col_values(spark, values, expr_fn, type_="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def test_hhmm_to_time_e9(spark):
    assert col_values(spark, ["2400", "5", "1435", None], X.hhmm_to_time) == \
        ["00:00:00", "00:05:00", "14:35:00", None]


def test_hhmm_to_time_invalid(spark):
    assert col_values(spark, ["2460"], lambda c: X.hhmm_to_time(c, strict=False)) == [None]
    with pytest.raises(Exception):
        col_values(spark, ["2460"], X.hhmm_to_time)


def test_hhmm_pad_e10(spark):
    assert col_values(spark, ["2400", "5", "1435", None], X.hhmm_pad) == ["0000", "0005", "1435", None]


def test_flag_e11(spark):
    assert col_values(spark, ["1.00", "0.00", None], X.flag) == [True, False, False]


def test_to_int_decimal_text(spark):
    assert col_values(spark, ["2024", "1.00", "2.5", "-2.5", None], X.to_int) == [2024, 1, 3, -3, None]


def test_strict_and_lenient_casts_e21(spark):
    assert col_values(spark, ["abc"], lambda c: X.to_int(c, strict=False)) == [None]
    assert col_values(spark, ["2024-13-45"], lambda c: X.to_date_iso(c, strict=False)) == [None]
    with pytest.raises(Exception):
        col_values(spark, ["abc"], X.to_int)
    with pytest.raises(Exception):
        col_values(spark, ["2024-13-45"], X.to_date_iso)


def test_double_not_float(spark):
    assert col_values(spark, ["0.1"], X.to_double) == [0.1]


def test_date_key_and_weekday(spark):
    df = spark.createDataFrame([("2024-09-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    r = df.select(X.date_key("d").alias("k"), X.day_of_week_sun0("d").alias("w")).first()
    assert (r.k, r.w) == (20240901, 0)          # a Sunday


def test_surrogate_key_null_tail_e13(spark):
    df = spark.createDataFrame([("AA", 12, "2024-01-05", "JFK", "LAX", None)],
                               "c string, n int, d string, o string, e string, t string")
    df = df.withColumn("d", F.col("d").cast("date"))
    got = df.select(surrogate_key("c", "n", "d", "o", "e", "t")).first()[0]
    assert got == hashlib.md5(b"AA-12-2024-01-05-JFK-LAX-").hexdigest()


def test_census_region_e15(spark):
    assert col_values(spark, ["NY", "IL", "TX", "CA", "PR", None], census_region) == \
        ["Northeast", "Midwest", "South", "West", "Territory/Other", "Territory/Other"]


def test_pct_exact_half_up(spark):
    df = spark.createDataFrame([(2469, 20000), (1, 8), (0, 5)], "p long, w long")
    assert [r[0] for r in df.select(pct("p", "w", 2)).collect()] == [12.35, 12.5, 0.0]


def test_pct_of_zero_total_e19(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (1.0, 8.0)], "p double, t double")
    assert [r[0] for r in df.select(pct_of("p", "t", 1)).collect()] == [None, None, 12.5]


def test_truncate_counts_the_line_end(spark):
    assert col_values(spark, ["a" * 199, "a" * 200, "b\t "], lambda c: truncate_text(c, 200)) == [
        "a" * 199, "a" * 200 + "...", "b"]


def test_strict_casts_fail_without_ansi(spark):
    import pytest
    from pyspark.sql import functions as F
    from tarmac.functions import casts as X
    df = spark.createDataFrame([("1x",)], "t string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for cast in (X.to_int, X.to_double, X.to_date_iso):
            assert df.select(cast("t", False).alias("v")).first().v is None
            with pytest.raises(Exception, match="cannot cast"):
                df.select(cast("t").alias("v")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_utc_texts_in_another_zone(spark):
    from pyspark.sql import functions as F
    from tarmac.functions.scalar import utc_iso, utc_offset_iso
    df = spark.range(1).select(F.lit("2024-07-01 14:26:16.5+00:00").cast("timestamp").alias("t"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert tuple(df.select(utc_iso("t"), utc_offset_iso("t")).first()) == (
            "2024-07-01T14:26:16Z", "2024-07-01T14:26:16.500000+00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_truncate_text(spark):
    assert col_values(spark, ["a" * 201, "short  "], lambda c: truncate_text(c, 200)) == \
        ["a" * 200 + "...", "short"]


def test_relative_path_strips_scheme_and_root(spark):
    from tarmac.sources.landing import relative_path
    rows = [("s3a://lake/flights/landing/year=2024/month=01/f.csv.gz",),
            ("file:/tmp/x/landing/year=2024/month=02/g.csv.gz",),
            ("hdfs://nn:8020/other/h.csv.gz",)]
    df = spark.createDataFrame(rows, "p string")
    got = [r[0] for r in df.select(relative_path(F.col("p"), "s3a://lake/flights/landing")).collect()]
    assert got[0] == "year=2024/month=01/f.csv.gz"
    assert got[2] == "/other/h.csv.gz"             # outside the root: path without scheme
    got2 = [r[0] for r in df.select(relative_path(F.col("p"), "/tmp/x/landing")).collect()]
    assert got2[1] == "year=2024/month=02/g.csv.gz"


def test_cluster_conf_sizes_from_largest_shuffle():
    from tarmac.session import cluster_conf
    rows = 170 * 10**9                            # ~100 TB of raw CSV at ~600 bytes a row
    conf = cluster_conf(total_cores=4000, largest_shuffle_bytes=16 * rows)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert parts % 4000 == 0 and 16 * rows / parts <= 256 << 20 and parts <= 20000
    assert int(cluster_conf(8, 1 << 20)["spark.sql.shuffle.partitions"]) == 16
