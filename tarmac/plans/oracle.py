"""DuckDB oracle SQL for every registered query.

These are *independent* SQL formulations of the same semantics (the Spark side
is DataFrame code).  They run on the driver's pre-registered parquet views.
Portability rules applied (see FIXTURES.md): rounding through
``decimal(38,10)``, short month/day names through ``strftime``, integer parts
cast to ``int``, counts cast to ``bigint``.
"""

from __future__ import annotations

from tarmac.functions.constants import (
    CARRIER_GROUP_DEFAULT, CARRIER_GROUPS, CARRIER_NAME_DEFAULT, CARRIER_NAMES, CENSUS_REGIONS, REGION_DEFAULT,
)
from tarmac.sources.schema import FILE_COLUMNS

# The F2 fixture: one all-text raw flight per line item.
RAW_FLIGHTS = """
with ap as (
  select * from (values
    (0,'JFK','12478','New York, NY','NY','New York'),
    (1,'ORD','13930','Chicago, IL','IL','Illinois'),
    (2,'DFW','11298','Dallas, TX','TX','Texas'),
    (3,'LAX','12892','Los Angeles, CA','CA','California'),
    (4,'SJU','14843','San Juan, PR','PR','Puerto Rico'),
    (5,'DCA','11278','Washington, DC','VA','Virginia'),
    (6,'ATL','10397','Atlanta, GA','GA','Georgia'),
    (7,'SEA','14747','Seattle, WA','WA','Washington'),
    (8,'BOS','10721','Boston, MA','MA','Massachusetts'),
    (9,'ZZZ','99999','Nowhere',cast(null as string),cast(null as string))
  ) as t(k,code,id,city,st,stn)
),
b as (
  select l.*,
    cast(l_orderkey % 340 as int) as dn,
    date '2024-01-01' + cast(l_orderkey % 340 as int) as d,
    (cast(l_quantity as int) * 37 + cast(l_partkey % 1000 as int)) % 150 - 40 as dl,
    cast(round(l_discount * 100) as int) as disc,
    cast((l_partkey % 24) * 100 + (l_suppkey % 60) as int) as hm,
    cast(floor(l_extendedprice) as int) % 2500 + 100 as dist
  from lineitem l
),
c as (
  select b.*, disc = 0 as canc, disc = 10 as divd,
    disc not in (0, 10) and dl >= 15 as late,
    case when hm = 0 then 2400 else hm end as hm2
  from b
)
select
  cast(year(d) as string) as Year,
  cast(quarter(d) as string) as Quarter,
  cast(month(d) as string) as Month,
  cast(day(d) as string) as DayofMonth,
  cast(dn % 7 + 1 as string) as DayOfWeek,
  cast(d as string) as FlightDate,
  case l_suppkey % 5 when 0 then 'AA' when 1 then 'UA' when 2 then 'DL' when 3 then 'WN' else 'B6' end as Reporting_Airline,
  cast(19000 + l_suppkey % 5 as string) as DOT_ID_Reporting_Airline,
  case l_suppkey % 5 when 0 then 'AA' when 1 then 'UA' when 2 then 'DL' when 3 then 'WN' else 'B6' end as IATA_CODE_Reporting_Airline,
  case when l_linenumber = 7 then null else 'N' || cast(l_suppkey * 10 + l_linenumber as string) end as Tail_Number,
  cast(l_partkey % 3000 + 1 as string) as Flight_Number_Reporting_Airline,
  o.id as OriginAirportID, o.code as Origin, o.city as OriginCityName, o.st as OriginState, o.stn as OriginStateName,
  e.id as DestAirportID, e.code as Dest, e.city as DestCityName, e.st as DestState, e.stn as DestStateName,
  cast(hm2 as string) as CRSDepTime,
  case when canc then null else cast(hm2 as string) end as DepTime,
  case when canc then null else cast(dl - 3 as string) || '.00' end as DepDelay,
  case when canc then null else cast(greatest(dl - 3, 0) as string) || '.00' end as DepDelayMinutes,
  case when canc then null when dl - 3 >= 15 then '1.00' else '0.00' end as DepDel15,
  cast(hm2 as string) as CRSArrTime,
  case when canc then null else cast(hm2 as string) end as ArrTime,
  case when canc or divd then null else cast(dl as string) || '.00' end as ArrDelay,
  case when canc or divd then null else cast(greatest(dl, 0) as string) || '.00' end as ArrDelayMinutes,
  case when canc or divd then null when dl >= 15 then '1.00' else '0.00' end as ArrDel15,
  case when canc then '1.00' else '0.00' end as Cancelled,
  case when canc then case l_linenumber % 3 when 0 then 'A' when 1 then 'B' else 'C' end end as CancellationCode,
  case when divd then '1.00' else '0.00' end as Diverted,
  cast(cast((dist - dist % 8) / 8 as int) + 30 as string) || '.00' as CRSElapsedTime,
  case when canc or divd then null else cast(cast((dist - dist % 8) / 8 as int) + 30 + dl % 10 as string) || '.00' end as ActualElapsedTime,
  case when canc or divd then null else cast(cast((dist - dist % 8) / 8 as int) as string) || '.00' end as AirTime,
  cast(dist as string) || '.00' as Distance,
  case when canc then null else cast(10 + l_linenumber as string) || '.00' end as TaxiOut,
  case when canc then null else cast(3 + l_linenumber as string) || '.00' end as TaxiIn,
  case when late then cast(dl % 5 as string) || '.00' end as CarrierDelay,
  case when late then cast(dl % 4 as string) || '.00' end as WeatherDelay,
  case when late then cast(dl % 3 as string) || '.00' end as NASDelay,
  case when late and l_suppkey % 5 <> 1 then cast(dl % 2 as string) || '.00' end as SecurityDelay,
  case when late then cast(dl - dl % 5 - dl % 4 - dl % 3 - dl % 2 as string) || '.00' end as LateAircraftDelay,
  'on_time_2024_' || lpad(cast(month(d) as string), 2, '0') || '.csv.gz' as _SOURCE_FILE,
  l_shipdate as _LOAD_TIMESTAMP
from c
join ap o on l_partkey % 10 = o.k
join ap e on (l_partkey + 1 + l_suppkey % 9) % 10 = e.k
"""


def _dep_time(c: str) -> str:
    return (f"case when cast(\"{c}\" as int) = 2400 then '00:00:00' "
            f"else strftime(strptime(lpad(\"{c}\", 4, '0'), '%H%M'), '%H:%M:%S') end")


def _arr_time(c: str) -> str:
    return f"case when cast(\"{c}\" as int) = 2400 then '0000' else lpad(\"{c}\", 4, '0') end"


STG_FLIGHTS = f"""
select
  cast("Year" as int) as flight_year,
  cast("Quarter" as int) as flight_quarter,
  cast("Month" as int) as flight_month,
  cast("DayofMonth" as int) as day_of_month,
  cast("DayOfWeek" as int) as day_of_week,
  cast("FlightDate" as date) as flight_date,
  "Reporting_Airline" as carrier_code,
  cast("DOT_ID_Reporting_Airline" as int) as dot_id_carrier,
  "IATA_CODE_Reporting_Airline" as iata_code_carrier,
  "Tail_Number" as tail_number,
  cast("Flight_Number_Reporting_Airline" as int) as flight_number,
  cast("OriginAirportID" as int) as origin_airport_id,
  "Origin" as origin, "OriginCityName" as origin_city, "OriginState" as origin_state,
  "OriginStateName" as origin_state_name,
  cast("DestAirportID" as int) as dest_airport_id,
  "Dest" as dest, "DestCityName" as dest_city, "DestState" as dest_state,
  "DestStateName" as dest_state_name,
  {_dep_time("CRSDepTime")} as crs_dep_time_raw,
  {_dep_time("DepTime")} as dep_time_raw,
  cast("DepDelay" as double) as dep_delay_min,
  cast("DepDelayMinutes" as double) as dep_delay_min_positive,
  cast("DepDel15" as double) as dep_delayed_15,
  {_arr_time("CRSArrTime")} as crs_arr_time_raw,
  {_arr_time("ArrTime")} as arr_time_raw,
  cast("ArrDelay" as double) as arr_delay_min,
  cast("ArrDelayMinutes" as double) as arr_delay_min_positive,
  cast("ArrDel15" as double) as arr_delayed_15,
  coalesce(cast("Cancelled" as double) = 1.0, false) as is_cancelled,
  "CancellationCode" as cancellation_code,
  coalesce(cast("Diverted" as double) = 1.0, false) as is_diverted,
  cast("CRSElapsedTime" as double) as crs_elapsed_time_min,
  cast("ActualElapsedTime" as double) as actual_elapsed_time_min,
  cast("AirTime" as double) as air_time_min,
  cast("Distance" as double) as distance_miles,
  cast("TaxiOut" as double) as taxi_out_min,
  cast("TaxiIn" as double) as taxi_in_min,
  cast("CarrierDelay" as double) as delay_carrier_min,
  cast("WeatherDelay" as double) as delay_weather_min,
  cast("NASDelay" as double) as delay_nas_min,
  cast("SecurityDelay" as double) as delay_security_min,
  cast("LateAircraftDelay" as double) as delay_late_aircraft_min,
  "_SOURCE_FILE" as source_file,
  "_LOAD_TIMESTAMP" as loaded_at
from raw_flights
where "Reporting_Airline" in ('AA', 'UA', 'DL')
"""

# MD5 of the '-'-joined parts, NULL read as ''.
KEY = "md5(" + " || '-' || ".join(f"coalesce(cast({c} as varchar), '')" for c in (
    "carrier_code", "flight_number", "flight_date", "origin", "dest", "tail_number")) + ")"

FACT_FLIGHTS = f"""
select
  {KEY} as flight_key,
  carrier_code as carrier_key, origin as origin_airport_key, dest as dest_airport_key,
  cast(strftime(flight_date, '%Y%m%d') as int) as date_key,
  tail_number, flight_number, flight_date,
  crs_dep_time_raw, dep_time_raw, dep_delay_min, dep_delayed_15,
  crs_arr_time_raw, arr_time_raw, arr_delay_min, arr_delayed_15,
  is_cancelled, is_diverted, cancellation_code,
  crs_elapsed_time_min, actual_elapsed_time_min, air_time_min, distance_miles, taxi_out_min, taxi_in_min,
  delay_carrier_min, delay_weather_min, delay_nas_min, delay_security_min, delay_late_aircraft_min,
  source_file, loaded_at
from stg_flights
"""


def _lookup(column: str, values: dict, default: str) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in values.items())
    return f"case {column} {whens} else '{default}' end"


DIM_CARRIER = f"""
select carrier_code as carrier_key, carrier_code, iata_code_carrier, dot_id_carrier,
  {_lookup("carrier_code", CARRIER_NAMES, CARRIER_NAME_DEFAULT)} as carrier_name,
  {_lookup("carrier_code", CARRIER_GROUPS, CARRIER_GROUP_DEFAULT)} as carrier_group
from (select distinct carrier_code, iata_code_carrier, dot_id_carrier from stg_flights) t
"""

REGION_CASE = "case " + " ".join(f"when state in {states} then '{region}'" for region, states in CENSUS_REGIONS) \
    + f" else '{REGION_DEFAULT}' end"

AIRPORTS_UNION = """
select distinct origin as airport_code, origin_airport_id as airport_id, origin_city as city,
       origin_state as state, origin_state_name as state_name from stg_flights
union
select distinct dest, dest_airport_id, dest_city, dest_state, dest_state_name from stg_flights
"""

DIM_AIRPORT = f"""
select airport_code as airport_key, airport_code, airport_id, city, state, state_name,
  {REGION_CASE} as region
from ({AIRPORTS_UNION}) t
"""

DATE_ATTRS = """
  cast(strftime(full_date, '%Y%m%d') as int) as date_key,
  full_date,
  cast(year(full_date) as int) as year,
  cast(quarter(full_date) as int) as quarter,
  cast(month(full_date) as int) as month_num,
  strftime(full_date, '%b') as month_name,
  cast(day(full_date) as int) as day_of_month,
  cast(dayofweek(full_date) as int) as day_of_week,
  strftime(full_date, '%a') as day_name,
  dayofweek(full_date) in (0, 6) as is_weekend"""

DATE_SPINE = "select cast(date '2024-01-01' + cast(i as int) as date) as full_date from range(366) t(i)"

DIM_DATE = f"""
select {DATE_ATTRS}
from ({DATE_SPINE}) s
where full_date <= (select max(flight_date) from stg_flights)
"""


def _round(expr: str, n: int) -> str:
    """Half-away rounding of a double through an exact decimal, as double."""
    return f"cast(round(cast({expr} as decimal(38,10)), {n}) as double)"


MART_KEYS = "carrier_key, carrier_name, year, month_num, month_name"

MART_JOINED = """
from fact_flights f
left join dim_carrier c on f.carrier_key = c.carrier_key
left join dim_date d on f.date_key = d.date_key
"""

STATUS_COUNTS = """cast(count(*) filter (where is_cancelled) as bigint) as cancelled_count,
    cast(count(*) filter (where is_diverted) as bigint) as diverted_count,
    cast(count(*) filter (where arr_delayed_15 = 0 and not is_cancelled and not is_diverted) as bigint) as on_time_count"""

MART_PERFORMANCE = f"""
select {MART_KEYS}, total_flights,
  cancelled_count, {_round("cancelled_count * 100.0 / total_flights", 2)} as cancelled_pct,
  diverted_count, {_round("diverted_count * 100.0 / total_flights", 2)} as diverted_pct,
  on_time_count, {_round("on_time_count * 100.0 / total_flights", 2)} as on_time_pct,
  {_round("avg_dep", 2)} as avg_dep_delay,
  {_round("avg_arr", 2)} as avg_arr_delay,
  {_round("p75", 2)} as p75_arr_delay,
  {_round("p95", 2)} as p95_arr_delay
from (
  select f.carrier_key, c.carrier_name, d.year, d.month_num, d.month_name,
    cast(count(*) as bigint) as total_flights,
    {STATUS_COUNTS},
    avg(case when not is_cancelled then dep_delay_min end) as avg_dep,
    avg(case when not is_cancelled then arr_delay_min end) as avg_arr,
    quantile_cont(arr_delay_min, 0.75) as p75,
    quantile_cont(arr_delay_min, 0.95) as p95
  {MART_JOINED}
  group by f.carrier_key, c.carrier_name, d.year, d.month_num, d.month_name
) a
"""

CAUSES = ("carrier", "weather", "nas", "security", "late_aircraft")

MART_DELAY_CAUSES = f"""
select {MART_KEYS}, delayed_flights_count,
  {", ".join(f"total_{c}_delay_min" for c in CAUSES)},
  total_delay_min,
  {", ".join(_round(f"total_{c}_delay_min * 100.0 / nullif(total_delay_min, 0)", 1) + f" as pct_{c}" for c in CAUSES)}
from (
  select *, {" + ".join(f"total_{c}_delay_min" for c in CAUSES)} as total_delay_min
  from (
    select f.carrier_key, c.carrier_name, d.year, d.month_num, d.month_name,
      cast(count(*) as bigint) as delayed_flights_count,
      {", ".join(f"round(sum(delay_{c}_min), 0) as total_{c}_delay_min" for c in CAUSES)}
    {MART_JOINED}
    where f.arr_delayed_15 = 1 and not f.is_cancelled
    group by f.carrier_key, c.carrier_name, d.year, d.month_num, d.month_name
  ) a
) b
"""


def with_models(body: str) -> str:
    """Prefix ``body`` with the model CTE chain (fixture -> staging -> core)."""
    return f"""with raw_flights as ({RAW_FLIGHTS}),
stg_flights as ({STG_FLIGHTS}),
fact_flights as ({FACT_FLIGHTS}),
dim_carrier as ({DIM_CARRIER}),
dim_airport as ({DIM_AIRPORT}),
dim_date as ({DIM_DATE})
{body}"""


# ------------------------------------------------------------------ data quality

def _dq(model: str, column: str, rule: str, failures_sql: str) -> str:
    return (f"select '{model}' as model, '{column}' as column_name, '{rule}' as rule, "
            f"cast(({failures_sql}) as bigint) as failures")


def dq_not_null_sql(model: str, columns) -> str:
    return "\nunion all\n".join(
        _dq(model, c, "not_null", f"select count(*) from {model} where {c} is null") for c in columns)


def _sql_lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def dq_accepted_values_sql(model: str, rules) -> str:
    parts = []
    for column, values in rules:
        lits = ", ".join(_sql_lit(v) for v in values)
        parts.append(_dq(model, column, "accepted_values",
                         f"select count(distinct {column}) from {model} "
                         f"where {column} is not null and {column} not in ({lits})"))
    return "\nunion all\n".join(parts)


def dq_unique_sql(pairs) -> str:
    return "\nunion all\n".join(
        _dq(model, c, "unique",
            f"select count(*) from (select {c} from {model} where {c} is not null "
            f"group by {c} having count(*) > 1) t")
        for model, c in pairs)


def dq_relationships_sql(model: str, rels) -> str:
    return "\nunion all\n".join(
        _dq(model, c, "relationships",
            f"select count(*) from {model} x where x.{c} is not null and not exists "
            f"(select 1 from {parent} p where p.{pc} = x.{c})")
        for c, parent, pc in rels)


# ------------------------------------------------------------------ load path

# --- fixed values: source columns the fixture fills ---
FIXTURE_TEXT_COLUMNS = (
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "FlightDate",
    "Reporting_Airline", "DOT_ID_Reporting_Airline", "IATA_CODE_Reporting_Airline",
    "Tail_Number", "Flight_Number_Reporting_Airline",
    "OriginAirportID", "Origin", "OriginCityName", "OriginState", "OriginStateName",
    "DestAirportID", "Dest", "DestCityName", "DestState", "DestStateName",
    "CRSDepTime", "DepTime", "DepDelay", "DepDelayMinutes", "DepDel15",
    "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes", "ArrDel15",
    "Cancelled", "CancellationCode", "Diverted",
    "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Distance", "TaxiOut", "TaxiIn",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
)


def raw_text_columns_sql() -> str:
    cols = ", ".join(f'"{c}"' for c in FIXTURE_TEXT_COLUMNS)
    return f"with raw_flights as ({RAW_FLIGHTS}) select {cols} from raw_flights"


LOAD_REPORT = f"""with raw_flights as ({RAW_FLIGHTS})
select "_SOURCE_FILE" as source_file, cast(count(*) as bigint) as n_rows,
       max("_LOAD_TIMESTAMP") as loaded_at
from raw_flights group by "_SOURCE_FILE"
"""

PENDING_MONTHS = f"""with raw_flights as ({RAW_FLIGHTS})
select distinct cast("Year" as int) as year, cast("Month" as int) as month
from raw_flights where cast("Month" as int) > 6
"""

TABLE_COUNTS = "\nunion all\n".join(
    f"select '{name}' as table_name, cast(count(*) as bigint) as n_rows from {src}"
    for name, src in (
        ("raw_flights", "raw_flights"), ("stg_flights", "stg_flights"),
        ("fact_flights", "fact_flights"), ("dim_carrier", "dim_carrier"),
        ("dim_airport", "dim_airport"), ("dim_date", "dim_date"),
        ("mart_carrier_performance_monthly", f"({MART_PERFORMANCE}) m1"),
        ("mart_delay_cause_breakdown_monthly", f"({MART_DELAY_CAUSES}) m2")))


# ------------------------------------------------------------------ single operators

_FACT_MONTH = "select *, cast(month(flight_date) as int) as flight_month from fact_flights"

_CAUSE_TOTALS = f"""
select *, {" + ".join(f"total_{c}_delay_min" for c in CAUSES)} as total_delay_min from (
  select carrier_key, flight_month, cast(count(*) as bigint) as delayed_flights_count,
    {", ".join(f"round(sum(delay_{c}_min), 0) as total_{c}_delay_min" for c in CAUSES)}
  from ({_FACT_MONTH}) f
  where arr_delayed_15 = 1 and not is_cancelled
  group by carrier_key, flight_month) a
"""

OPERATOR_SQL = {
    "carrier_filter": with_models(
        '''select "Reporting_Airline", "FlightDate", "Flight_Number_Reporting_Airline", "Origin", "Dest",
                  "Tail_Number" from raw_flights where "Reporting_Airline" in ('AA', 'UA', 'DL')'''),
    "hhmm_times": with_models(
        f'''select "CRSDepTime", "DepTime", "CRSArrTime", "ArrTime",
                   {_dep_time("CRSDepTime")} as crs_dep_time_raw, {_dep_time("DepTime")} as dep_time_raw,
                   {_arr_time("CRSArrTime")} as crs_arr_time_raw, {_arr_time("ArrTime")} as arr_time_raw
            from raw_flights'''),
    "status_flags": with_models(
        '''select "Cancelled", "Diverted", "CancellationCode",
                  coalesce(cast("Cancelled" as double) = 1.0, false) as is_cancelled,
                  coalesce(cast("Diverted" as double) = 1.0, false) as is_diverted
           from raw_flights'''),
    "typed_casts": with_models(
        '''select cast("Year" as int) as flight_year, cast("Month" as int) as flight_month,
                  cast("DOT_ID_Reporting_Airline" as int) as dot_id_carrier,
                  cast("Flight_Number_Reporting_Airline" as int) as flight_number,
                  cast("FlightDate" as date) as flight_date, cast("DepDelay" as double) as dep_delay_min,
                  cast("Distance" as double) as distance_miles,
                  cast("SecurityDelay" as double) as delay_security_min
           from raw_flights'''),
    "surrogate_key": with_models(
        f'''select carrier_code, flight_number, flight_date, origin, dest, tail_number,
                  {KEY} as flight_key,
                  cast(strftime(flight_date, '%Y%m%d') as int) as date_key
           from stg_flights'''),
    "date_spine_dynamic": with_models(
        '''select cast(strftime(full_date, '%Y%m%d') as int) as date_key, full_date,
                  strftime(full_date, '%b') as month_name, strftime(full_date, '%a') as day_name,
                  cast(dayofweek(full_date) as int) as day_of_week,
                  dayofweek(full_date) in (0, 6) as is_weekend
           from (select cast(unnest(generate_series(min(flight_date), max(flight_date), interval 1 day))
                             as date) as full_date
                 from stg_flights having count(flight_date) > 0) s'''),
    "airport_regions": with_models(
        f'''select origin, origin_state, {REGION_CASE.replace("state in", "origin_state in")} as origin_region,
                   dest, dest_state, {REGION_CASE.replace("state in", "dest_state in")} as dest_region
            from stg_flights'''),
    "monthly_status_counts": with_models(
        f'''select *, {_round("cancelled_count * 100.0 / total_flights", 2)} as cancelled_pct,
                   {_round("diverted_count * 100.0 / total_flights", 2)} as diverted_pct,
                   {_round("on_time_count * 100.0 / total_flights", 2)} as on_time_pct
            from (select carrier_key, flight_month, cast(count(*) as bigint) as total_flights,
                    {STATUS_COUNTS}
                  from ({_FACT_MONTH}) f group by carrier_key, flight_month) a'''),
    "delay_averages": with_models(
        f'''select carrier_key, flight_month,
                   {_round("avg(case when not is_cancelled then dep_delay_min end)", 2)} as avg_dep_delay,
                   {_round("avg(case when not is_cancelled then arr_delay_min end)", 2)} as avg_arr_delay
            from ({_FACT_MONTH}) f group by carrier_key, flight_month'''),
    "delay_percentiles": with_models(
        f'''select carrier_key, flight_month,
                   {_round("quantile_cont(arr_delay_min, 0.75)", 2)} as p75_arr_delay,
                   {_round("quantile_cont(arr_delay_min, 0.95)", 2)} as p95_arr_delay
            from ({_FACT_MONTH}) f group by carrier_key, flight_month'''),
    "delay_cause_totals": with_models(_CAUSE_TOTALS),
    "delay_cause_shares": with_models(
        f'''select carrier_key, flight_month,
                   {", ".join(_round(f"total_{c}_delay_min * 100.0 / nullif(total_delay_min, 0)", 1)
                              + f" as pct_{c}" for c in CAUSES)}
            from ({_CAUSE_TOTALS}) t'''),
    "dim_left_joins": with_models(
        '''select f.flight_key, f.carrier_key, f.date_key, c.carrier_name, d.year, d.month_num, d.month_name
           from fact_flights f left join dim_carrier c on f.carrier_key = c.carrier_key
           left join dim_date d on f.date_key = d.date_key'''),
}

INGESTION_LOG_MONTHS = f"""with raw_flights as ({RAW_FLIGHTS})
select distinct 'flights_ingestion' as pipeline_name,
  'DOT BTS Reporting Carrier On-Time Performance' as source_system,
  'recompress_and_upload_gzip' as step,
  cast("Year" as int) as year, cast("Month" as int) as month, 'SUCCESS' as status,
  'eu-west-1' as aws_region, '2024-07-01T09:26:16+00:00' as uploaded_at_utc,
  'ingestion_' || cast("Year" as int) || '_' || lpad("Month", 2, '0') || '_gzip_20240701T092616Z.json' as log_name,
  true as size_ok, true as sha_ok
from raw_flights
"""

# Line number 7 lands broken; month and line number come from the same derivation as the fixture.
_LINES = """select l_linenumber as ln, cast(month(date '2024-01-01' + cast(l_orderkey % 340 as int)) as varchar) as "Month"
from lineitem"""

LOAD_COUNTS = f"""select cast(count(*) as bigint) as parsed, cast(count(*) filter (where ln <> 7) as bigint) as loaded,
  cast(count(*) filter (where ln = 7) as bigint) as rejected,
  cast(count(*) filter (where ln <> 7) as bigint) as told_loaded,
  cast(count(*) filter (where ln = 7) as bigint) as told_rejected from ({_LINES}) x"""

LOAD_REJECTS = f"""select "Month", cast(count(*) filter (where ln <> 7) as bigint) as good,
  cast(count(*) filter (where ln = 7) as bigint) as bad from ({_LINES}) x group by 1"""

STRICT_CAST_ERRORS = f"""select "Month", cast(count(*) filter (where ln = 7) as bigint) as bad_int,
  cast(count(*) filter (where ln = 7) as bigint) as bad_double,
  cast(count(*) filter (where ln = 7) as bigint) as bad_date, cast(count(*) as bigint) as n
from ({_LINES}) x group by 1"""

COMPRESSION = f"""with raw_flights as ({RAW_FLIGHTS})
select distinct cast("Month" as int) as month, true as smaller, true as share_ok from raw_flights"""

NUMBERED = RAW_FLIGHTS.replace("l_shipdate as _LOAD_TIMESTAMP", "l_shipdate as _LOAD_TIMESTAMP, l_linenumber as ln")

LOAD_RAGGED = f"""select "Year", "Month", "FlightDate", "Reporting_Airline",
  case when ln % 2 = 1 then "Origin" end as "Origin", case when ln % 2 = 1 then "Dest" end as "Dest"
from ({NUMBERED}) r"""


LOG_DOCUMENTS = f"""with raw_flights as ({RAW_FLIGHTS})
select distinct 'ingestion_' || cast("Year" as int) || '_' || lpad("Month", 2, '0') || '_gzip_20240701T092616Z.json' as document,
  'pipeline_name source_system step year month s3_bucket s3_key aws_region filename file_size_bytes file_sha256 uploaded_at_utc status' as fields,
  'flights_ingestion' as pipeline_name, 'DOT BTS Reporting Carrier On-Time Performance' as source_system,
  'recompress_and_upload_gzip' as step, cast("Year" as int) as year, cast("Month" as int) as month,
  'eu-west-1' as aws_region, '2024-07-01T09:26:16+00:00' as uploaded_at_utc, 'SUCCESS' as status,
  true as size_ok, true as sha_ok, true as name_ok
from raw_flights"""

INSPECT_FILES = f"""with raw_flights as ({RAW_FLIGHTS})
select cast("Month" as int) as month, cast(count(*) as bigint) as n_lines, cast(count(*) as bigint) as n_records,
  {len(FILE_COLUMNS)} as n_columns, '{" ".join(FILE_COLUMNS[:10])}' as first_columns,
  '{" ".join(FILE_COLUMNS[-5:])}' as last_columns, 203 as shown, true as cut, true as first_line
from raw_flights group by 1"""

# Line numbers 6 and 7 land broken, one file a month, sorted; line 1 is the header.
LOAD_FIRST_ERRORS = """
with x as (select cast(month(date '2024-01-01' + cast(l_orderkey % 340 as int)) as int) as month, l_linenumber as ln,
  row_number() over (partition by month(date '2024-01-01' + cast(l_orderkey % 340 as int))
                     order by l_orderkey, l_linenumber, l_partkey) + 1 as line from lineitem),
m as (select month, count(*) as n, count(*) filter (where ln < 6) as good, min(line) filter (where ln >= 6) as line,
             arg_min(ln, line) filter (where ln >= 6) as ln from x group by month)
select month, case when line is null then 'LOADED' when good > 0 then 'PARTIALLY_LOADED' else 'LOAD_FAILED' end as status,
  cast(n as bigint) as rows_parsed, cast(good as bigint) as rows_loaded, cast(n - good as bigint) as errors_seen,
  case ln when 7 then 'quoted field is not closed' when 6 then 'text after a closing quote' end as first_error,
  cast(line as bigint) as first_error_line, case when line is not null then 10 end as first_error_character,
  case when line is not null then 'DayofMonth' end as first_error_column_name from m"""


# ------------------------------------------------------------------ runs that follow one another

FACT_WITHOUT_AUDIT = with_models("select * exclude (source_file, loaded_at) from fact_flights")

CHANGED_FILES = with_models(MART_PERFORMANCE).replace(f"with raw_flights as ({RAW_FLIGHTS})", f"""with raw_flights as (
  select * exclude (ln) from ({NUMBERED}) x
  where cast("Month" as int) not in (4, 5) and (cast("Month" as int) <> 3 or ln <= 3))""", 1)

READER_STEPS = with_models("""select s.step, cast(case s.step when 'folders' then 2 else count(*) filter (
    where f.m < 3 or f.m = 3 and (s.step in ('before', 'opened_before') or not f.is_cancelled)) end as bigint) as n
from (values ('before'), ('opened_before'), ('after'), ('failed'), ('folders')) s(step)
cross join (select month(flight_date) as m, is_cancelled from fact_flights) f group by s.step""")

BOTH_MARTS = with_models(f"""select * from ({MART_PERFORMANCE}) p left join ({MART_DELAY_CAUSES}) c
using ({MART_KEYS})""")

LEGS = with_models("""select s.scope, cast(count(*) filter (where s.scope = 'all' or l.last > 6) as bigint) as failures
from (values ('all'), ('new')) s(scope) cross join (
  select max(month(flight_date)) as last from fact_flights
  group by carrier_key, flight_number, origin_airport_key, dest_airport_key having count(*) > 1) l
group by s.scope""")

RUN_SQL = {
    "monthly_run_counts": with_models(TABLE_COUNTS),
    "run_after_crash": FACT_WITHOUT_AUDIT,
    "run_changed_files": CHANGED_FILES,
    "table_reader_steps": READER_STEPS,
    "marts_from_partial_runs": BOTH_MARTS,
    "unique_across_months": LEGS,
}
