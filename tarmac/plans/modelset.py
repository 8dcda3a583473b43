"""The model graph over one input folder, as lazily built logical plans."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tarmac.plans import models as M
from tarmac.sources.fixture import fixture_raw


class ModelSet:
    """The model graph over one input folder, built lazily (plans only)."""

    def __init__(self, spark: SparkSession, sf_dir: str, strict: bool = True):
        self.spark, self.sf_dir, self.strict = spark, sf_dir, strict

    @cached_property
    def raw(self) -> DataFrame:
        return fixture_raw(self.spark, self.sf_dir)

    @cached_property
    def stg(self) -> DataFrame:
        return M.stg_flights(self.raw, strict=self.strict)

    @cached_property
    def fact(self) -> DataFrame:
        return M.fact_flights(self.stg)

    @cached_property
    def dim_carrier(self) -> DataFrame:
        return M.dim_carrier(self.stg)

    @cached_property
    def dim_airport(self) -> DataFrame:
        return M.dim_airport(self.stg)

    @cached_property
    def dim_date(self) -> DataFrame:
        return M.dim_date(self.stg)

    def mart_carrier_performance(self) -> DataFrame:
        return M.mart_carrier_performance(self.fact, self.dim_carrier, self.dim_date)

    def mart_delay_causes(self) -> DataFrame:
        return M.mart_delay_causes(self.fact, self.dim_carrier, self.dim_date)
