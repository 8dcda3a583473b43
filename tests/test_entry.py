"""Driver contract: entry, registry and the oracle comparison at sf0.001."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from conftest import SF001  # noqa: E402
from tarmac.oracle_check import compare  # noqa: E402


from tarmac.plans.registry import QUERIES as REFERENCE  # noqa: E402


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() == 36
    assert df.columns[:5] == ["carrier_key", "carrier_name", "year", "month_num", "month_name"]


def test_every_query_has_oracle():
    assert set(REFERENCE) <= set(E.oracle_sql())


def test_all_queries_match_oracle_sf0001(spark):
    res = compare(spark, SF001, list(REFERENCE), verbose=False)
    bad = {k: v for k, v in res.items() if v.get("match") is not True}
    assert not bad, bad
