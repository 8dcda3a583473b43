"""Derived raw-flights fixture over the driver's ``lineitem`` table.

The driver ships TPC-H-style tables, not flights.  This module turns every
line item into one all-text raw flight row with the same shape the landing
CSVs have, so every model and rule runs over data whose size grows with the
input.  It is a pure projection (no join, no shuffle): the airport lookup is an
``element_at`` into a 10-entry literal array.

The same derivation is written in SQL for the DuckDB oracle; the two are
independent implementations that must agree row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.memo import per_jvm
from tarmac.session import for_wide_rows

# --- fixed values: fixture airports (index, code, airport id, city, state, state name) ---
FIXTURE_AIRPORTS = (
    (0, "JFK", "12478", "New York, NY", "NY", "New York"),
    (1, "ORD", "13930", "Chicago, IL", "IL", "Illinois"),
    (2, "DFW", "11298", "Dallas, TX", "TX", "Texas"),
    (3, "LAX", "12892", "Los Angeles, CA", "CA", "California"),
    (4, "SJU", "14843", "San Juan, PR", "PR", "Puerto Rico"),
    (5, "DCA", "11278", "Washington, DC", "VA", "Virginia"),
    (6, "ATL", "10397", "Atlanta, GA", "GA", "Georgia"),
    (7, "SEA", "14747", "Seattle, WA", "WA", "Washington"),
    (8, "BOS", "10721", "Boston, MA", "MA", "Massachusetts"),
    (9, "ZZZ", "99999", "Nowhere", None, None),
)
# --- fixed values: fixture carriers by l_suppkey % 5 ---
FIXTURE_CARRIERS = ("AA", "UA", "DL", "WN", "B6")
FIXTURE_DAYS = 340
FIXTURE_START = "2024-01-01"


def _airport_array() -> Column:
    return F.array(*[
        F.struct(F.lit(code).alias("code"), F.lit(aid).alias("id"), F.lit(city).alias("city"),
                 F.lit(st).cast("string").alias("st"), F.lit(stn).cast("string").alias("stn"))
        for _, code, aid, city, st, stn in FIXTURE_AIRPORTS
    ])


def _s(col: Column) -> Column:
    return col.cast("string")


def _dec(col: Column) -> Column:
    """Integer rendered as ``'<n>.00'`` like the source files' numeric text."""
    return F.concat(col.cast("string"), F.lit(".00"))


def raw_flights_from_lineitem(lineitem: DataFrame, extra=()) -> DataFrame:
    """One raw flight (all text + 2 audit columns) per line item, with ``extra`` key columns."""
    for_wide_rows(lineitem.sparkSession)
    keep, stage1, stage2 = _fixture_exprs()
    return lineitem.where(keep).select(*stage1).select(*stage2, *extra)


@per_jvm
def _fixture_exprs():
    """(row filter, first projection, final projection) of the derivation."""
    pk, sk, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    n_ap = len(FIXTURE_AIRPORTS)
    o_idx = pk % n_ap
    e_idx = (pk + 1 + sk % 9) % n_ap
    airports = _airport_array()

    # the derivation is an inner lookup: rows without a valid index drop out
    keep = o_idx.between(0, n_ap - 1) & e_idx.between(0, n_ap - 1)
    stage1 = [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        (F.col("l_orderkey") % FIXTURE_DAYS).cast("int").alias("dn"),
        ((F.col("l_quantity").cast("int") * 37 + (pk % 1000).cast("int")) % 150 - 40).alias("dl"),
        F.round(F.col("l_discount") * 100).cast("int").alias("disc"),
        ((pk % 24) * 100 + (sk % 60)).cast("int").alias("hm"),
        (F.floor("l_extendedprice").cast("int") % 2500 + 100).alias("dist"),
        F.element_at(airports, (o_idx + 1).cast("int")).alias("o"),
        F.element_at(airports, (e_idx + 1).cast("int")).alias("e"),
    ]
    dn, dl, disc, hm, dist = (F.col(c) for c in ("dn", "dl", "disc", "hm", "dist"))
    d = F.date_add(F.lit(FIXTURE_START).cast("date"), dn)
    canc = disc == 0
    divd = disc == 10
    late = ~disc.isin(0, 10) & (dl >= 15)
    hm2 = F.when(hm == 0, F.lit(2400)).otherwise(hm)
    carrier = F.element_at(F.array(*[F.lit(c) for c in FIXTURE_CARRIERS]), (sk % 5 + 1).cast("int"))
    air = ((dist - dist % 8) / 8).cast("int")
    null_s = F.lit(None).cast("string")

    def unless(cond: Column, value: Column) -> Column:
        return F.when(cond, null_s).otherwise(value)

    stage2 = [
        _s(F.year(d)).alias("Year"),
        _s(F.quarter(d)).alias("Quarter"),
        _s(F.month(d)).alias("Month"),
        _s(F.dayofmonth(d)).alias("DayofMonth"),
        _s(dn % 7 + 1).alias("DayOfWeek"),
        _s(d).alias("FlightDate"),
        carrier.alias("Reporting_Airline"),
        _s(19000 + sk % 5).alias("DOT_ID_Reporting_Airline"),
        carrier.alias("IATA_CODE_Reporting_Airline"),
        F.when(ln == 7, null_s).otherwise(F.concat(F.lit("N"), _s(sk * 10 + ln))).alias("Tail_Number"),
        _s(pk % 3000 + 1).alias("Flight_Number_Reporting_Airline"),
        F.col("o.id").alias("OriginAirportID"), F.col("o.code").alias("Origin"),
        F.col("o.city").alias("OriginCityName"), F.col("o.st").alias("OriginState"),
        F.col("o.stn").alias("OriginStateName"),
        F.col("e.id").alias("DestAirportID"), F.col("e.code").alias("Dest"),
        F.col("e.city").alias("DestCityName"), F.col("e.st").alias("DestState"),
        F.col("e.stn").alias("DestStateName"),
        _s(hm2).alias("CRSDepTime"),
        unless(canc, _s(hm2)).alias("DepTime"),
        unless(canc, _dec(dl - 3)).alias("DepDelay"),
        unless(canc, _dec(F.greatest(dl - 3, F.lit(0)))).alias("DepDelayMinutes"),
        unless(canc, F.when(dl - 3 >= 15, F.lit("1.00")).otherwise(F.lit("0.00"))).alias("DepDel15"),
        _s(hm2).alias("CRSArrTime"),
        unless(canc, _s(hm2)).alias("ArrTime"),
        unless(canc | divd, _dec(dl)).alias("ArrDelay"),
        unless(canc | divd, _dec(F.greatest(dl, F.lit(0)))).alias("ArrDelayMinutes"),
        unless(canc | divd, F.when(dl >= 15, F.lit("1.00")).otherwise(F.lit("0.00"))).alias("ArrDel15"),
        F.when(canc, F.lit("1.00")).otherwise(F.lit("0.00")).alias("Cancelled"),
        F.when(canc, F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (ln % 3 + 1).cast("int")))
         .alias("CancellationCode"),
        F.when(divd, F.lit("1.00")).otherwise(F.lit("0.00")).alias("Diverted"),
        _dec(air + 30).alias("CRSElapsedTime"),
        unless(canc | divd, _dec(air + 30 + dl % 10)).alias("ActualElapsedTime"),
        unless(canc | divd, _dec(air)).alias("AirTime"),
        _dec(dist).alias("Distance"),
        unless(canc, _dec(10 + ln)).alias("TaxiOut"),
        unless(canc, _dec(3 + ln)).alias("TaxiIn"),
        F.when(late, _dec(dl % 5)).alias("CarrierDelay"),
        F.when(late, _dec(dl % 4)).alias("WeatherDelay"),
        F.when(late, _dec(dl % 3)).alias("NASDelay"),
        F.when(late & (sk % 5 != 1), _dec(dl % 2)).alias("SecurityDelay"),
        F.when(late, _dec(dl - dl % 5 - dl % 4 - dl % 3 - dl % 2)).alias("LateAircraftDelay"),
        F.concat(F.lit("on_time_2024_"), F.lpad(_s(F.month(d)), 2, "0"), F.lit(".csv.gz"))
         .alias("_SOURCE_FILE"),
        F.col("l_shipdate").alias("_LOAD_TIMESTAMP"),
    ]
    return keep, stage1, stage2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet) by name."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights derived from ``<sf_dir>/lineitem.parquet``."""
    return raw_flights_from_lineitem(read_table(spark, sf_dir, "lineitem"))
