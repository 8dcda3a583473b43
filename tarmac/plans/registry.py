"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query reads the driver's tables (``lineitem`` through the raw-flights
fixture) so its work grows with the input; none runs on made-up input alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators import quality as Q
from tarmac.plans import oracle as O
from tarmac.plans import ingest_queries as I
from tarmac.plans import rule_suites as R
from tarmac.plans import operator_queries as P
from tarmac.plans import run_queries as U
from tarmac.plans.modelset import ModelSet
from tarmac.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _model(attr: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        value = getattr(ModelSet(spark, sf_dir), attr)
        return value() if callable(value) else value
    run.__name__ = attr
    return run


# ------------------------------------------------------------------ data quality

def dq_not_null(spark, sf_dir):
    m = ModelSet(spark, sf_dir)
    return Q.check_rows(m.stg, "stg_flights", R.stg_not_null_rules())


def dq_accepted_values(spark, sf_dir):
    m = ModelSet(spark, sf_dir)
    return Q.check_rows(m.stg, "stg_flights", R.stg_accepted_values_rules())


def dq_declared(spark, sf_dir):
    """The 17 declared staging rules, one scan."""
    m = ModelSet(spark, sf_dir)
    return Q.run_checks(spark, [("stg_flights", m.stg, R.stg_declared_rules())])


def dq_unique(spark, sf_dir):
    m = ModelSet(spark, sf_dir)
    return Q.run_checks(spark, R.key_unique_suite(m.fact, m.dim_carrier, m.dim_airport, m.dim_date))


def dq_relationships(spark, sf_dir):
    m = ModelSet(spark, sf_dir)
    # staged once: each relationship then reads one stored column
    path = scratch_path(spark, "fact-keys")
    m.fact.select("carrier_key", "origin_airport_key", "dest_airport_key", "date_key").write.parquet(path)
    return Q.check_model(spark.read.parquet(path), "fact_flights",
                         R.fact_relationship_rules(m.dim_carrier, m.dim_airport, m.dim_date))


QUERIES: dict[str, Query] = {
    "stg_flights": _model("stg"),
    "fact_flights": _model("fact"),
    "dim_carrier": _model("dim_carrier"),
    "dim_airport": _model("dim_airport"),
    "dim_date": _model("dim_date"),
    "mart_carrier_performance": _model("mart_carrier_performance"),
    "mart_delay_causes": _model("mart_delay_causes"),
    "dq_not_null": dq_not_null,
    "dq_accepted_values": dq_accepted_values,
    "dq_declared": dq_declared,
    "dq_unique": dq_unique,
    "dq_relationships": dq_relationships,
    "load_roundtrip": I.load_roundtrip,
    "load_incremental_twice": I.load_incremental_twice,
    "load_report": I.load_report_query,
    "pending_files": I.pending_months,
    "load_backfill_old_file": I.load_backfill_old_file,
    "load_all_depths": I.load_all_depths,
    "load_counts": I.load_counts_query,
    "load_rejects": I.load_rejects,
    "load_ragged": I.load_ragged,
    "load_first_errors": I.load_first_errors,
    "load_quote_grammar": I.load_quote_grammar,
    "load_pattern": I.load_pattern,
    "load_path_pattern": I.load_path_pattern,
    "load_same_bytes_once": I.load_same_bytes_once,
    "log_documents": I.log_documents,
    "inspect_files": I.inspect_files,
    "land_late_rows": I.land_late_rows,
    "compression_report": I.compression_query,
    "strict_cast_errors": I.strict_cast_errors,
    "fact_month_rebuild": I.fact_month_rebuild,
    "build_mart_layer": I.build_mart_layer,
    "mart_order": I.mart_order,
    "ingestion_log_months": I.ingestion_log_months,
    **P.QUERIES,
    **U.QUERIES,
}

# --- fixed values: accepted values declared on stg_flights (for the oracle) ---
_ACCEPTED = [("carrier_code", ["AA", "DL", "UA"]), ("is_cancelled", [True, False]),
             ("is_diverted", [True, False]), ("flight_year", [2024]),
             ("flight_month", list(range(1, 13)))]

ORACLE_SQL: dict[str, str] = {
    "stg_flights": O.with_models("select * from stg_flights"),
    "fact_flights": O.with_models("select * from fact_flights"),
    "dim_carrier": O.with_models("select * from dim_carrier"),
    "dim_airport": O.with_models("select * from dim_airport"),
    "dim_date": O.with_models("select * from dim_date"),
    "mart_carrier_performance": O.with_models(O.MART_PERFORMANCE),
    "mart_delay_causes": O.with_models(O.MART_DELAY_CAUSES),
    "dq_not_null": O.with_models(O.dq_not_null_sql("stg_flights", R.STG_NOT_NULL)),
    "dq_accepted_values": O.with_models(O.dq_accepted_values_sql("stg_flights", _ACCEPTED)),
    "dq_declared": O.with_models(O.dq_not_null_sql("stg_flights", R.STG_NOT_NULL) + "\nunion all\n"
                                 + O.dq_accepted_values_sql("stg_flights", _ACCEPTED)),
    "dq_unique": O.with_models(O.dq_unique_sql([
        ("fact_flights", "flight_key"), ("dim_carrier", "carrier_key"),
        ("dim_airport", "airport_key"), ("dim_date", "date_key")])),
    "dq_relationships": O.with_models(O.dq_relationships_sql("fact_flights", [
        ("carrier_key", "dim_carrier", "carrier_key"),
        ("origin_airport_key", "dim_airport", "airport_key"),
        ("dest_airport_key", "dim_airport", "airport_key"),
        ("date_key", "dim_date", "date_key")])),
    "load_roundtrip": O.raw_text_columns_sql(),
    "load_incremental_twice": O.raw_text_columns_sql(),
    "load_report": O.LOAD_REPORT,
    "pending_files": O.PENDING_MONTHS,
    "load_backfill_old_file": O.raw_text_columns_sql(),
    "load_all_depths": O.raw_text_columns_sql(),
    "load_counts": O.LOAD_COUNTS,
    "load_rejects": O.LOAD_REJECTS,
    "load_ragged": O.LOAD_RAGGED,
    "load_first_errors": O.LOAD_FIRST_ERRORS,
    "load_quote_grammar": O.raw_text_columns_sql().replace(O.RAW_FLIGHTS, f"select * exclude (ln) from ({O.NUMBERED}) x "
                                                          "where ln < 6"),
    "load_pattern": O.raw_text_columns_sql() + ' where cast("Month" as int) <= 6',
    "load_path_pattern": O.raw_text_columns_sql() + ' where cast("Month" as int) not between 5 and 8',
    "load_same_bytes_once": O.raw_text_columns_sql(),
    "log_documents": O.LOG_DOCUMENTS,
    "inspect_files": O.INSPECT_FILES,
    "land_late_rows": O.raw_text_columns_sql(),
    "compression_report": O.COMPRESSION,
    "strict_cast_errors": O.STRICT_CAST_ERRORS,
    "fact_month_rebuild": O.with_models("select * from fact_flights where month(flight_date) <> 5"),
    "build_mart_layer": O.with_models(O.MART_PERFORMANCE),
    "mart_order": O.with_models(f"""select carrier_key, year, month_num, cast(row_number() over (
        order by carrier_key nulls first, year nulls first, month_num nulls first) as int) as position
        from ({O.MART_PERFORMANCE}) m"""),
    "ingestion_log_months": O.INGESTION_LOG_MONTHS,
    **O.OPERATOR_SQL,
    **O.RUN_SQL,
}
