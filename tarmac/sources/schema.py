"""The raw landing schema: 110 positional CSV columns + 2 audit columns.

Every column is text; the file is mapped by position, never by header name.
The 40 diversion-leg columns follow one rule (5 legs x 8 attributes) and are
generated from it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: named source columns in file order (before diversion legs) ---
_BASE_COLUMNS = (
    # calendar
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "FlightDate",
    # carrier
    "Reporting_Airline", "DOT_ID_Reporting_Airline", "IATA_CODE_Reporting_Airline",
    "Tail_Number", "Flight_Number_Reporting_Airline",
    # origin
    "OriginAirportID", "OriginAirportSeqID", "OriginCityMarketID", "Origin",
    "OriginCityName", "OriginState", "OriginStateFips", "OriginStateName", "OriginWac",
    # destination
    "DestAirportID", "DestAirportSeqID", "DestCityMarketID", "Dest",
    "DestCityName", "DestState", "DestStateFips", "DestStateName", "DestWac",
    # departure
    "CRSDepTime", "DepTime", "DepDelay", "DepDelayMinutes", "DepDel15",
    "DepartureDelayGroups", "DepTimeBlk", "TaxiOut", "WheelsOff", "WheelsOn", "TaxiIn",
    # arrival
    "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes", "ArrDel15",
    "ArrivalDelayGroups", "ArrTimeBlk",
    # status
    "Cancelled", "CancellationCode", "Diverted",
    # duration
    "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Flights", "Distance", "DistanceGroup",
    # delay causes
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
    # gate return
    "FirstDepTime", "TotalAddGTime", "LongestAddGTime",
    # diversion summary
    "DivAirportLandings", "DivReachedDest", "DivActualElapsedTime", "DivArrDelay", "DivDistance",
)
# --- fixed values: attributes of one diversion leg, in file order ---
_DIV_LEG_ATTRS = ("Airport", "AirportID", "AirportSeqID", "WheelsOn",
                  "TotalGTime", "LongestGTime", "WheelsOff", "TailNum")
DIVERSION_LEGS = 5
TRAILING_COLUMN = "_TRAILING_EMPTY_COL"

SOURCE_FILE_COL = "_SOURCE_FILE"
LOAD_TS_COL = "_LOAD_TIMESTAMP"


def _diversion_columns() -> tuple[str, ...]:
    return tuple(f"Div{k}{a}" for k in range(1, DIVERSION_LEGS + 1) for a in _DIV_LEG_ATTRS)


# 110 positional file columns
FILE_COLUMNS: tuple[str, ...] = _BASE_COLUMNS + _diversion_columns() + (TRAILING_COLUMN,)
# 112 raw-table columns
RAW_COLUMNS: tuple[str, ...] = FILE_COLUMNS + (SOURCE_FILE_COL, LOAD_TS_COL)

FILE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in FILE_COLUMNS])
RAW_SCHEMA = T.StructType(
    list(FILE_SCHEMA.fields)
    + [T.StructField(SOURCE_FILE_COL, T.StringType(), True),
       T.StructField(LOAD_TS_COL, T.TimestampNTZType(), True)]
)

assert len(FILE_COLUMNS) == 110 and len(RAW_COLUMNS) == 112
