"""Models over hand-made rows (E12, E14, E16-E18, E20, E22) and invariants on sf0.001."""

from pyspark.sql import functions as F

from conftest import SF001
from helpers_raw import cancelled, late, raw_df
from tarmac.plans import models as M
from tarmac.plans.build import build, preview
from tarmac.plans.modelset import ModelSet


def star(spark, rows):
    stg = M.stg_flights(raw_df(spark, rows))
    fact, car, dat = M.fact_flights(stg), M.dim_carrier(stg), M.dim_date(stg)
    return stg, fact, car, dat


def test_staging_filters_carriers_e14(spark):
    stg, *_ = star(spark, [{}, {"Reporting_Airline": "WN"}, {"Reporting_Airline": "DL"}])
    assert sorted(r.carrier_code for r in stg.collect()) == ["AA", "DL"]
    assert len(stg.columns) == 47


def test_cancelled_excluded_from_average_e12(spark):
    _, fact, car, dat = star(spark, [{"DepDelay": "10.00"}, {"DepDelay": "20.00"},
                                     cancelled()])
    r = M.mart_carrier_performance(fact, car, dat).first()
    assert r.total_flights == 3 and r.cancelled_count == 1
    assert r.avg_dep_delay == 15.0
    assert r.cancelled_pct == 33.33


def test_diverted_counted_not_on_time_e22(spark):
    diverted = {"Diverted": "1.00", "ArrDelay": None, "ArrDelayMinutes": None, "ArrDel15": None}
    _, fact, car, dat = star(spark, [{}, diverted])
    r = M.mart_carrier_performance(fact, car, dat).first()
    assert (r.total_flights, r.diverted_count, r.on_time_count) == (2, 1, 1)
    assert r.on_time_pct == 50.0


def test_flight_outside_calendar_e16(spark):
    _, fact, car, dat = star(spark, [{}, {"Year": "2025", "FlightDate": "2025-01-03"}])
    assert fact.count() == 2
    assert dat.count() == 366                 # capped by the spine, not by 2025-01-03
    rows = M.mart_carrier_performance(fact, car, dat).collect()
    assert sorted((r.year, r.total_flights) for r in rows if r.year) == [(2024, 1)]
    assert [r.total_flights for r in rows if r.year is None] == [1]


def test_empty_staging_gives_empty_calendar_e17(spark):
    stg = M.stg_flights(raw_df(spark, [{"Reporting_Airline": "WN"}]))
    assert M.dim_date(stg).count() == 0


def test_null_cause_makes_total_null_e18(spark):
    rows = [late(30, carrier=10, weather=0, nas=5, security=None, late_aircraft=15)]
    _, fact, car, dat = star(spark, rows)
    r = M.mart_delay_causes(fact, car, dat).first()
    assert r.delayed_flights_count == 1
    assert r.total_carrier_delay_min == 10.0 and r.total_security_delay_min is None
    assert r.total_delay_min is None and r.pct_carrier is None


def test_zero_total_gives_null_shares_e19(spark):
    rows = [late(20, carrier=0, weather=0, nas=0, security=0, late_aircraft=0)]
    _, fact, car, dat = star(spark, rows)
    r = M.mart_delay_causes(fact, car, dat).first()
    assert r.total_delay_min == 0.0 and r.pct_weather is None


def test_two_dot_ids_double_counts_e20(spark):
    _, fact, car, dat = star(spark, [{}, {"DOT_ID_Reporting_Airline": "19999"}])
    assert car.count() == 2
    r = M.mart_carrier_performance(fact, car, dat).first()
    assert r.total_flights == 4               # each fact row matches two carrier rows


def test_mart_invariants_sf0001(spark):
    m = ModelSet(spark, SF001)
    n_fact = m.fact.count()
    perf = m.mart_carrier_performance().collect()
    assert sum(r.total_flights for r in perf) == n_fact
    assert all(r.cancelled_count + r.on_time_count <= r.total_flights for r in perf)
    causes = m.mart_delay_causes().collect()
    for r in causes:
        shares = [r.pct_carrier, r.pct_weather, r.pct_nas, r.pct_security, r.pct_late_aircraft]
        if None not in shares:
            assert abs(sum(shares) - 100.0) < 0.6
    assert len(perf) == 36 and len(causes) == 36


def test_mart_plan_broadcasts_dimensions(spark):
    m = ModelSet(spark, SF001)
    plan = m.mart_carrier_performance()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # one percentile aggregate (both quantiles in one buffer), partial + final
    assert plan.count("percentile(") == 2


def test_dim_airport_one_scan(spark):
    m = ModelSet(spark, SF001)
    plan = m.dim_airport._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Generate explode" in plan
    regions = {r.airport_code: r.region for r in m.dim_airport.collect()}
    assert regions["SJU"] == "Territory/Other" and regions["ZZZ"] == "Territory/Other"
    assert regions["JFK"] == "Northeast" and regions["DCA"] == "South"


def test_build_layers_and_preview(spark, tmp_path):
    raw = ModelSet(spark, SF001).raw
    cat = build(spark, raw, str(tmp_path / "models"))
    assert set(cat.names()) >= {"stg_flights", "fact_flights", "dim_carrier", "dim_airport", "dim_date",
                                "mart_carrier_performance_monthly", "mart_delay_cause_breakdown_monthly"}
    assert preview(cat, "fact_flights", 5).count() == 5
    assert spark.table("dim_date").count() == cat.table("dim_date").count()
    only_core = build(spark, raw, None, until="dim_carrier", register_views=False)
    assert "mart_carrier_performance_monthly" not in only_core.names()
    assert only_core.table("dim_carrier").where(F.col("carrier_group") == "Major").count() == 3


def test_one_pass_marts_equal_separate_marts(spark):
    m = ModelSet(spark, SF001)
    stats = M.carrier_month_stats(m.fact, m.dim_carrier, m.dim_date)
    a = M.mart_carrier_performance_from_stats(stats)
    b = M.mart_delay_causes_from_stats(stats)
    assert a.exceptAll(m.mart_carrier_performance()).count() == 0
    assert m.mart_carrier_performance().exceptAll(a).count() == 0
    assert b.exceptAll(m.mart_delay_causes()).count() == 0
    assert m.mart_delay_causes().exceptAll(b).count() == 0


def test_delay_mart_drops_groups_without_delays(spark):
    _, fact, car, dat = star(spark, [{}, {"Month": "2", "FlightDate": "2024-02-01"} | {
        "ArrDelay": "30.00", "ArrDel15": "1.00", "CarrierDelay": "30.00", "WeatherDelay": "0.00",
        "NASDelay": "0.00", "SecurityDelay": "0.00", "LateAircraftDelay": "0.00"}])
    stats = M.carrier_month_stats(fact, car, dat)
    assert [r.month_num for r in M.mart_delay_causes_from_stats(stats).collect()] == [2]
    assert [r.month_num for r in M.mart_delay_causes(fact, car, dat).collect()] == [2]
    assert M.mart_carrier_performance_from_stats(stats).count() == 2


def test_lenient_build_stages_bad_text_as_null(spark):
    raw = raw_df(spark, [{}, {"FlightDate": "2024-13-45", "Flight_Number_Reporting_Airline": "x1"}])
    cat = build(spark, raw, None, until="stg_flights", register_views=False, strict=False)
    rows = sorted(cat.table("stg_flights").collect(), key=lambda r: r.flight_date is None)
    assert rows[1].flight_date is None and rows[1].flight_number is None
    import pytest
    with pytest.raises(Exception):
        build(spark, raw, None, until="stg_flights", register_views=False).table("stg_flights").collect()


def test_time_type_option(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        stg = M.stg_flights(raw_df(spark, [{"CRSDepTime": "2400"}, {"CRSDepTime": "905"}]), time_type=True)
        assert dict(stg.dtypes)["crs_dep_time_raw"].startswith("time")
        import datetime as dt
        assert sorted(r.crs_dep_time_raw for r in stg.collect()) == [dt.time(0, 0), dt.time(9, 5)]
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


def test_dynamic_calendar_bounds(spark):
    stg = M.stg_flights(raw_df(spark, [{"FlightDate": "2024-03-30"}, {"FlightDate": "2024-04-02"}]))
    days = [r.full_date.isoformat() for r in M.dim_date(stg, dynamic=True).orderBy("full_date").collect()]
    assert days == ["2024-03-30", "2024-03-31", "2024-04-01", "2024-04-02"]
    assert M.dim_date(stg).count() == 93            # fixed start 2024-01-01 .. 2024-04-02


def test_partitioned_fact_and_month_rebuild(spark, tmp_path):
    from tarmac.plans.build import rebuild_fact_months
    jan = {"Month": "1", "FlightDate": "2024-01-05"}
    feb = {"Month": "2", "FlightDate": "2024-02-05"}
    raw1 = raw_df(spark, [jan, jan, feb])
    out = str(tmp_path / "wh")
    cat = build(spark, raw1, out, fact_partitioned=True, register_views=False)
    fact = cat.table("fact_flights")
    assert sorted(r.flight_month_key for r in fact.collect()) == [202401, 202401, 202402]
    assert cat.table("mart_carrier_performance_monthly").count() == 2
    # February is re-delivered with three flights; January must stay untouched
    raw2 = raw_df(spark, [jan, feb, feb, feb])
    after = rebuild_fact_months(spark, raw2, out, [(2024, 2)])
    got = sorted((r.flight_month_key, 1) for r in after.collect())
    assert [k for k, _ in got] == [202401, 202401, 202402, 202402, 202402]
