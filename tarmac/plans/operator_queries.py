"""Registered queries that isolate single operators of the models.

Each one runs over the whole fixture derived from ``lineitem`` and exercises
one operator family (filter, time-of-day conversion, flags, casts, surrogate
key, calendar generation, regions, conditional counts, averages, percentiles,
cause totals and shares, dimension joins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import casts as X
from tarmac.functions.constants import STAGED_CARRIERS, WEEKEND_DAYS
from tarmac.functions.scalar import census_region, surrogate_key
from tarmac.operators.relational import filter_carriers, join_dim
from tarmac.plans import models as M
from tarmac.plans.modelset import ModelSet
from tarmac.sources.calendar import date_spine_between


def carrier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw rows of the kept carriers (IN-list pushed to the scan)."""
    raw = ModelSet(spark, sf_dir).raw
    return filter_carriers(raw, "Reporting_Airline", STAGED_CARRIERS).select(
        "Reporting_Airline", "FlightDate", "Flight_Number_Reporting_Airline",
        "Origin", "Dest", "Tail_Number")


def hhmm_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HHMM text -> time of day (departures) and padded HHMM (arrivals)."""
    raw = ModelSet(spark, sf_dir).raw
    return raw.select(
        "CRSDepTime", "DepTime", "CRSArrTime", "ArrTime",
        X.hhmm_to_time("CRSDepTime").alias("crs_dep_time_raw"),
        X.hhmm_to_time("DepTime").alias("dep_time_raw"),
        X.hhmm_pad("CRSArrTime").alias("crs_arr_time_raw"),
        X.hhmm_pad("ArrTime").alias("arr_time_raw"))


def status_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: indicator text -> never-NULL booleans."""
    raw = ModelSet(spark, sf_dir).raw
    return raw.select("Cancelled", "Diverted", "CancellationCode",
                      X.flag("Cancelled").alias("is_cancelled"),
                      X.flag("Diverted").alias("is_diverted"))


def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text -> int / date / double."""
    raw = ModelSet(spark, sf_dir).raw
    return raw.select(
        X.to_int("Year").alias("flight_year"),
        X.to_int("Month").alias("flight_month"),
        X.to_int("DOT_ID_Reporting_Airline").alias("dot_id_carrier"),
        X.to_int("Flight_Number_Reporting_Airline").alias("flight_number"),
        X.to_date_iso("FlightDate").alias("flight_date"),
        X.to_double("DepDelay").alias("dep_delay_min"),
        X.to_double("Distance").alias("distance_miles"),
        X.to_double("SecurityDelay").alias("delay_security_min"))


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD5 over '-'-joined components, NULL read as ''."""
    stg = ModelSet(spark, sf_dir).stg
    return stg.select(
        "carrier_code", "flight_number", "flight_date", "origin", "dest", "tail_number",
        surrogate_key("carrier_code", "flight_number", "flight_date", "origin", "dest",
                      "tail_number").alias("flight_key"),
        X.date_key("flight_date").alias("date_key"))


def date_spine_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 with data-driven bounds: every day from the first to the last
    staged flight date, with calendar attributes."""
    stg = ModelSet(spark, sf_dir).stg
    d = F.col("full_date")
    return date_spine_between(stg, "flight_date").select(
        X.date_key(d).alias("date_key"), d,
        F.date_format(d, "MMM").alias("month_name"),
        F.date_format(d, "EEE").alias("day_name"),
        X.day_of_week_sun0(d).alias("day_of_week"),
        X.day_of_week_sun0(d).isin(*WEEKEND_DAYS).alias("is_weekend"))


def airport_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census region of both ends of each staged flight."""
    stg = ModelSet(spark, sf_dir).stg
    return stg.select("origin", "origin_state", census_region("origin_state").alias("origin_region"),
                      "dest", "dest_state", census_region("dest_state").alias("dest_region"))


def _carrier_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts' measures per carrier and month, from the fact's day sums (no dimension)."""
    days = M.day_sums(ModelSet(spark, sf_dir).fact)
    return M.stats_of(days.withColumn("flight_month", (F.col("date_key") / 100).cast("int") % 100),
                      ("carrier_key", "flight_month"))


def monthly_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2-A4: counts, conditional counts and exact-decimal shares per carrier and month."""
    return _carrier_month(spark, sf_dir).select("carrier_key", "flight_month", *M.PERFORMANCE[:7])


def delay_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: averages over non-cancelled flights, rounded to 2 decimals."""
    return _carrier_month(spark, sf_dir).select("carrier_key", "flight_month", "avg_dep_delay", "avg_arr_delay")


def delay_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact interpolated 75th/95th percentiles, one aggregate buffer."""
    return _carrier_month(spark, sf_dir).select("carrier_key", "flight_month", "p75_arr_delay", "p95_arr_delay")


def _with_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _carrier_month(spark, sf_dir).where("delayed_flights_count > 0")


def delay_cause_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded cause sums and their (NULL-propagating) grand total."""
    return _with_delays(spark, sf_dir).select("carrier_key", "flight_month", *M.CAUSE_TOTALS)


def delay_cause_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each cause, NULL when the total is zero or NULL."""
    return _with_delays(spark, sf_dir).select("carrier_key", "flight_month", *M.CAUSE_SHARES)


def dim_left_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact LEFT JOIN carrier and date dimensions ."""
    m = ModelSet(spark, sf_dir)
    f = join_dim(m.fact.select("flight_key", "carrier_key", "date_key"), m.dim_carrier,
                 "carrier_key", ["carrier_name"])
    return join_dim(f, m.dim_date, "date_key", ["year", "month_num", "month_name"])


QUERIES = {
    "carrier_filter": carrier_filter,
    "hhmm_times": hhmm_times,
    "status_flags": status_flags,
    "typed_casts": typed_casts,
    "surrogate_key": surrogate_keys,
    "date_spine_dynamic": date_spine_dynamic,
    "airport_regions": airport_regions,
    "monthly_status_counts": monthly_status_counts,
    "delay_averages": delay_averages,
    "delay_percentiles": delay_percentiles,
    "delay_cause_totals": delay_cause_totals,
    "delay_cause_shares": delay_cause_shares,
    "dim_left_joins": dim_left_joins,
}
