"""Build small raw-flight DataFrames from partial rows (test helper)."""

import datetime as dt

from tarmac.sources.schema import RAW_COLUMNS, RAW_SCHEMA

DEFAULT = {
    "Year": "2024", "Quarter": "1", "Month": "1", "DayofMonth": "5", "DayOfWeek": "5",
    "FlightDate": "2024-01-05", "Reporting_Airline": "AA", "DOT_ID_Reporting_Airline": "19805",
    "IATA_CODE_Reporting_Airline": "AA", "Tail_Number": "N1", "Flight_Number_Reporting_Airline": "1",
    "OriginAirportID": "12478", "Origin": "JFK", "OriginCityName": "New York, NY", "OriginState": "NY",
    "OriginStateName": "New York", "DestAirportID": "12892", "Dest": "LAX",
    "DestCityName": "Los Angeles, CA", "DestState": "CA", "DestStateName": "California",
    "CRSDepTime": "900", "DepTime": "905", "DepDelay": "5.00", "DepDelayMinutes": "5.00",
    "DepDel15": "0.00", "CRSArrTime": "1200", "ArrTime": "1210", "ArrDelay": "10.00",
    "ArrDelayMinutes": "10.00", "ArrDel15": "0.00", "Cancelled": "0.00", "Diverted": "0.00",
    "CRSElapsedTime": "360.00", "ActualElapsedTime": "365.00", "AirTime": "330.00",
    "Distance": "2475.00", "TaxiOut": "20.00", "TaxiIn": "15.00",
    "_SOURCE_FILE": "year=2024/month=01/on_time_2024_01.csv.gz",
    "_LOAD_TIMESTAMP": dt.datetime(2024, 2, 1),
}


def raw_df(spark, rows):
    data = []
    for r in rows:
        full = {**DEFAULT, **r}
        data.append(tuple(full.get(c) for c in RAW_COLUMNS))
    return spark.createDataFrame(data, RAW_SCHEMA)


def cancelled(**kw):
    return {"Cancelled": "1.00", "DepTime": None, "DepDelay": None, "DepDelayMinutes": None,
            "DepDel15": None, "ArrTime": None, "ArrDelay": None, "ArrDelayMinutes": None,
            "ArrDel15": None, "CancellationCode": "B", **kw}


def late(minutes, **causes):
    base = {"ArrDelay": f"{minutes}.00", "ArrDelayMinutes": f"{minutes}.00", "ArrDel15": "1.00"}
    names = {"carrier": "CarrierDelay", "weather": "WeatherDelay", "nas": "NASDelay",
             "security": "SecurityDelay", "late_aircraft": "LateAircraftDelay"}
    for k, v in causes.items():
        base[names[k]] = None if v is None else f"{v}.00"
    return base
