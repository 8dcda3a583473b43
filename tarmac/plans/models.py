"""The seven models: raw -> staging -> star schema -> marts.

Each model is a function from input DataFrames to a DataFrame (an unresolved
logical plan); nothing executes until the caller writes or collects.  Catalyst
collapses the projection chains, prunes columns down to the parquet scan and
pushes the carrier filter below the casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import casts as X
from tarmac.functions.memo import per_jvm
from tarmac.functions.constants import (
    CARRIER_GROUP_DEFAULT, CARRIER_GROUPS, CARRIER_NAME_DEFAULT, CARRIER_NAMES,
    DATE_SPINE_DAYS, DATE_SPINE_START, STAGED_CARRIERS, WEEKEND_DAYS,
)
from tarmac.functions.scalar import (
    census_region, count_where, lookup, pct, pct_of, surrogate_key,
)
from tarmac.operators.relational import (
    airports_union, distinct_cols, filter_carriers, join_dim, rename_cast,
)
from tarmac.sources.calendar import date_spine, date_spine_between

# ------------------------------------------------------------------ staging

@per_jvm
def staging_spec(strict: bool = True, time_type: bool = False):
    """(output name, column expression) pairs of the staging projection.
    ``time_type`` renders departure times as Spark TIME (opt-in flag)."""
    i = lambda c: X.to_int(c, strict)       # noqa: E731
    f = lambda c: X.to_double(c, strict)
    s = F.col
    return [
        # date & time
        ("flight_year", i("Year")),
        ("flight_quarter", i("Quarter")),
        ("flight_month", i("Month")),
        ("day_of_month", i("DayofMonth")),
        ("day_of_week", i("DayOfWeek")),
        ("flight_date", X.to_date_iso("FlightDate", strict)),
        # carrier
        ("carrier_code", s("Reporting_Airline")),
        ("dot_id_carrier", i("DOT_ID_Reporting_Airline")),
        ("iata_code_carrier", s("IATA_CODE_Reporting_Airline")),
        ("tail_number", s("Tail_Number")),
        ("flight_number", i("Flight_Number_Reporting_Airline")),
        # origin and destination
        ("origin_airport_id", i("OriginAirportID")),
        ("origin", s("Origin")),
        ("origin_city", s("OriginCityName")),
        ("origin_state", s("OriginState")),
        ("origin_state_name", s("OriginStateName")),
        ("dest_airport_id", i("DestAirportID")),
        ("dest", s("Dest")),
        ("dest_city", s("DestCityName")),
        ("dest_state", s("DestState")),
        ("dest_state_name", s("DestStateName")),
        # departure: a time of day; arrival: padded HHMM text (kept asymmetric)
        ("crs_dep_time_raw", X.hhmm_to_time("CRSDepTime", strict, time_type)),
        ("dep_time_raw", X.hhmm_to_time("DepTime", strict, time_type)),
        ("dep_delay_min", f("DepDelay")),
        ("dep_delay_min_positive", f("DepDelayMinutes")),
        ("dep_delayed_15", f("DepDel15")),
        ("crs_arr_time_raw", X.hhmm_pad("CRSArrTime", strict)),
        ("arr_time_raw", X.hhmm_pad("ArrTime", strict)),
        ("arr_delay_min", f("ArrDelay")),
        ("arr_delay_min_positive", f("ArrDelayMinutes")),
        ("arr_delayed_15", f("ArrDel15")),
        # status
        ("is_cancelled", X.flag("Cancelled", strict)),
        ("cancellation_code", s("CancellationCode")),
        ("is_diverted", X.flag("Diverted", strict)),
        # duration
        ("crs_elapsed_time_min", f("CRSElapsedTime")),
        ("actual_elapsed_time_min", f("ActualElapsedTime")),
        ("air_time_min", f("AirTime")),
        ("distance_miles", f("Distance")),
        ("taxi_out_min", f("TaxiOut")),
        ("taxi_in_min", f("TaxiIn")),
        # delay causes (filled only when >= 15 min late and not cancelled)
        ("delay_carrier_min", f("CarrierDelay")),
        ("delay_weather_min", f("WeatherDelay")),
        ("delay_nas_min", f("NASDelay")),
        ("delay_security_min", f("SecurityDelay")),
        ("delay_late_aircraft_min", f("LateAircraftDelay")),
        # metadata
        ("source_file", s("_SOURCE_FILE")),
        ("loaded_at", s("_LOAD_TIMESTAMP")),
    ]


def stg_flights(raw: DataFrame, carriers=STAGED_CARRIERS, strict: bool = True,
                time_type: bool = False) -> DataFrame:
    """Typed, cleaned staging rows of the kept carriers (47 columns).

    The carrier filter is applied first and is a plain predicate on a raw
    column, so it reaches the scan; casts run only on surviving rows.
    """
    return rename_cast(filter_carriers(raw, "Reporting_Airline", carriers),
                       staging_spec(strict, time_type))


# ------------------------------------------------------------------ core

FACT_COLUMNS = (
    "flight_key", "carrier_key", "origin_airport_key", "dest_airport_key", "date_key",
    "tail_number", "flight_number", "flight_date",
    "crs_dep_time_raw", "dep_time_raw", "dep_delay_min", "dep_delayed_15",
    "crs_arr_time_raw", "arr_time_raw", "arr_delay_min", "arr_delayed_15",
    "is_cancelled", "is_diverted", "cancellation_code",
    "crs_elapsed_time_min", "actual_elapsed_time_min", "air_time_min", "distance_miles",
    "taxi_out_min", "taxi_in_min",
    "delay_carrier_min", "delay_weather_min", "delay_nas_min", "delay_security_min",
    "delay_late_aircraft_min",
    "source_file", "loaded_at",
)


def fact_flights(stg: DataFrame) -> DataFrame:
    """One row per staged flight leg with an MD5 surrogate key and the
    role-playing keys (origin and destination both point at airports).
    A narrow projection: no shuffle, no dedup (uniqueness is checked, Q5)."""
    derived = {
        "flight_key": surrogate_key("carrier_code", "flight_number", "flight_date",
                                    "origin", "dest", "tail_number"),
        "carrier_key": F.col("carrier_code"),
        "origin_airport_key": F.col("origin"),
        "dest_airport_key": F.col("dest"),
        "date_key": X.date_key("flight_date"),
    }
    return stg.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in FACT_COLUMNS])


def dim_carrier(stg: DataFrame) -> DataFrame:
    """One row per distinct (code, IATA code, DOT id) with name and group."""
    carriers = distinct_cols(stg, ["carrier_code", "iata_code_carrier", "dot_id_carrier"])
    return carriers.select(
        F.col("carrier_code").alias("carrier_key"),
        "carrier_code", "iata_code_carrier", "dot_id_carrier",
        lookup("carrier_code", CARRIER_NAMES, CARRIER_NAME_DEFAULT).alias("carrier_name"),
        lookup("carrier_code", CARRIER_GROUPS, CARRIER_GROUP_DEFAULT).alias("carrier_group"),
    )


AIRPORT_ROLES = {
    "origin": {"airport_code": "origin", "airport_id": "origin_airport_id", "city": "origin_city",
               "state": "origin_state", "state_name": "origin_state_name"},
    "dest": {"airport_code": "dest", "airport_id": "dest_airport_id", "city": "dest_city",
             "state": "dest_state", "state_name": "dest_state_name"},
}


def dim_airport(stg: DataFrame) -> DataFrame:
    """Distinct airports seen as origin or destination, with Census region.
    One scan of staging (both roles unpivoted in the same pass)."""
    airports = airports_union(stg, AIRPORT_ROLES)
    return airports.select(
        F.col("airport_code").alias("airport_key"),
        "airport_code", "airport_id", "city", "state", "state_name",
        census_region("state").alias("region"),
    )


def dim_date(stg: DataFrame, start: str = DATE_SPINE_START, days: int = DATE_SPINE_DAYS,
             dynamic: bool = False) -> DataFrame:
    """Calendar rows ``start .. start+days-1`` capped at the latest staged
    flight date (an uncorrelated scalar subquery; empty staging -> no rows).

    ``dynamic=True`` (opt-in) spans the first to the last flight date instead
    of a fixed start and length.
    """
    if dynamic:
        spine = date_spine_between(stg, "flight_date")
    else:
        latest = stg.select(F.max("flight_date")).scalar()
        spine = date_spine(stg.sparkSession, start, days).where(F.col("full_date") <= latest)
    d = F.col("full_date")
    return (spine
            .select(X.date_key(d).alias("date_key"),
                    d,
                    F.year(d).alias("year"),
                    F.quarter(d).alias("quarter"),
                    F.month(d).alias("month_num"),
                    F.date_format(d, "MMM").alias("month_name"),
                    F.dayofmonth(d).alias("day_of_month"),
                    X.day_of_week_sun0(d).alias("day_of_week"),
                    F.date_format(d, "EEE").alias("day_name"),
                    X.day_of_week_sun0(d).isin(*WEEKEND_DAYS).alias("is_weekend")))


# ------------------------------------------------------------------ marts

MART_KEYS = ("carrier_key", "carrier_name", "year", "month_num", "month_name")


def mart_carrier_performance(fact: DataFrame, carriers: DataFrame, dates: DataFrame) -> DataFrame:
    """Monthly volume, cancellation, diversion, on-time and delay statistics per carrier."""
    return mart_carrier_performance_from_stats(carrier_month_stats(fact, carriers, dates))


CAUSES = ("carrier", "weather", "nas", "security", "late_aircraft")


def _grand_total(cols):
    """Sum of columns with SQL ``+`` (one NULL makes the total NULL)."""
    total = None
    for c in cols:
        total = F.col(c) if total is None else total + F.col(c)
    return total


def mart_delay_causes(fact: DataFrame, carriers: DataFrame, dates: DataFrame) -> DataFrame:
    """Monthly delay minutes by cause per carrier over flights >= 15 min late and not cancelled."""
    return mart_delay_causes_from_stats(carrier_month_stats(fact, carriers, dates))


# ------------------------------------------------------------------ both marts, one pass

def carrier_month_stats(fact: DataFrame, carriers: DataFrame, dates: DataFrame) -> DataFrame:
    """Every aggregate of both marts in ONE pass over the fact.

    The dimensions join the day sums: a few rows per carrier and day.  Duplicate
    dimension keys multiply those rows, and with them every count and frequency, as
    they would the flights.
    """
    return stats_from_days(day_sums(fact), carriers, dates)


def stats_from_days(days: DataFrame, carriers: DataFrame, dates: DataFrame) -> DataFrame:
    """The same from day sums, which may be stored ones: sums of them equal sums of their flights."""
    days = join_dim(days, carriers, "carrier_key", ["carrier_name"])
    days = join_dim(days, dates, "date_key", ["year", "month_num", "month_name"])
    return stats_of(days, MART_KEYS)


def day_sums(fact: DataFrame) -> DataFrame:
    """The fact added up per (carrier, date, arrival delay) with plain hash aggregates.

    The delayed-flight filter of the delay-cause mart is a condition inside its sums.
    """
    canc, divd = F.col("is_cancelled"), F.col("is_diverted")
    delayed = (F.col("arr_delayed_15") == 1) & ~canc
    return fact.groupBy("carrier_key", "date_key", "arr_delay_min").agg(
        F.count(F.lit(1)).alias("n"),
        count_where(canc).alias("cancelled"), count_where(divd).alias("diverted"),
        count_where((F.col("arr_delayed_15") == 0) & ~canc & ~divd).alias("on_time"),
        F.sum(F.when(~canc, F.col("dep_delay_min"))).alias("dep_sum"),
        F.count(F.when(~canc, F.col("dep_delay_min"))).alias("dep_n"),
        F.sum(F.when(~canc, F.col("arr_delay_min"))).alias("arr_sum"),
        F.count(F.when(~canc, F.col("arr_delay_min"))).alias("arr_n"),
        count_where(delayed).alias("late"),
        *[F.sum(F.when(delayed, F.col(f"delay_{c}_min"))).alias(f"late_{c}") for c in CAUSES])


def stats_of(days: DataFrame, keys) -> DataFrame:
    """All measures of the marts per ``keys``, from day sums; percentiles read values with frequencies."""
    def mean(part: str):
        return F.round(F.try_divide(F.sum(f"{part}_sum"), F.sum(f"{part}_n")), 2)

    stats = days.groupBy(*keys).agg(
        F.sum("n").alias("total_flights"), F.sum("cancelled").alias("cancelled_count"),
        F.sum("diverted").alias("diverted_count"), F.sum("on_time").alias("on_time_count"),
        mean("dep").alias("avg_dep_delay"), mean("arr").alias("avg_arr_delay"),
        F.percentile("arr_delay_min", F.array(F.lit(0.75), F.lit(0.95)), F.col("n")).alias("_p"),
        F.sum("late").alias("delayed_flights_count"),
        *[F.round(F.sum(f"late_{c}"), 0).alias(f"total_{c}_delay_min") for c in CAUSES])
    # grand total = sum of the *rounded* sums; one NULL cause makes it NULL
    total = _grand_total(f"total_{c}_delay_min" for c in CAUSES)
    return stats.withColumn("total_delay_min", total).select(
        *keys, "total_flights",
        *[x for c in ("cancelled", "diverted", "on_time")
          for x in (f"{c}_count", pct(f"{c}_count", "total_flights", 2).alias(f"{c}_pct"))],
        "avg_dep_delay", "avg_arr_delay",
        F.round(F.col("_p")[0], 2).alias("p75_arr_delay"), F.round(F.col("_p")[1], 2).alias("p95_arr_delay"),
        "delayed_flights_count", *[f"total_{c}_delay_min" for c in CAUSES], "total_delay_min",
        *[pct_of(f"total_{c}_delay_min", "total_delay_min", 1).alias(f"pct_{c}") for c in CAUSES])


PERFORMANCE = ("total_flights", "cancelled_count", "cancelled_pct", "diverted_count", "diverted_pct",
               "on_time_count", "on_time_pct", "avg_dep_delay", "avg_arr_delay", "p75_arr_delay", "p95_arr_delay")
CAUSE_TOTALS = ("delayed_flights_count", *(f"total_{c}_delay_min" for c in CAUSES), "total_delay_min")
CAUSE_SHARES = tuple(f"pct_{c}" for c in CAUSES)


def mart_carrier_performance_from_stats(stats: DataFrame) -> DataFrame:
    return (stats.select(*MART_KEYS, *PERFORMANCE).orderBy("carrier_key", "year", "month_num"))


def mart_delay_causes_from_stats(stats: DataFrame) -> DataFrame:
    """Groups without a delayed flight do not exist in the filtered mart."""
    return (stats.where(F.col("delayed_flights_count") > 0)
            .select(*MART_KEYS, *CAUSE_TOTALS, *CAUSE_SHARES).orderBy("carrier_key", "year", "month_num"))
