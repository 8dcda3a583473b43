"""tarmac: flight on-time analytics as Spark jobs.

Subpackages: ``sources`` (scans, schema, fixture), ``functions`` (column
expressions), ``operators`` (relational, quality, bookkeeping),
``plans`` (models, build, monthly run, registry), ``streaming`` (incremental
load), ``sinks`` (writers and logs).

The common entry points are re-exported here::

    from tarmac import get_spark, read_raw, load_raw, build, run_checks
"""

from tarmac.operators.quality import (
    accepted_values, assert_passed, not_null, offending_values, relationships, run_checks, unique,
)
from tarmac.plans.build import build, preview, rebuild_fact_months
from tarmac.plans.models import (
    dim_airport, dim_carrier, dim_date, fact_flights, mart_carrier_performance,
    mart_delay_causes, stg_flights,
)
from tarmac.session import cluster_conf, get_spark
from tarmac.sinks.files import land_csv_gz, write_ingestion_log
from tarmac.sources.files import file_manifest, inspect_csv
from tarmac.sources.landing import read_raw
from tarmac.streaming.incremental import load_raw, read_loaded

__all__ = [
    "get_spark", "cluster_conf",
    "read_raw", "load_raw", "read_loaded", "land_csv_gz", "file_manifest", "inspect_csv",
    "write_ingestion_log",
    "stg_flights", "fact_flights", "dim_carrier", "dim_airport", "dim_date",
    "mart_carrier_performance", "mart_delay_causes", "build", "preview", "rebuild_fact_months",
    "not_null", "accepted_values", "unique", "relationships", "run_checks", "assert_passed",
    "offending_values",
]
