"""Generated calendar rows (the date spine)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: str, days: int) -> DataFrame:
    """``days`` consecutive dates from ``start`` as column ``full_date``.

    Built from ``spark.range`` (a row ordinal), so it never runs backwards and
    its size is fixed by ``days``: safe to broadcast.
    """
    if days < 0:
        raise ValueError("days must be >= 0")
    return spark.range(days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("full_date"))


def date_spine_between(df_dates: DataFrame, date_col: str) -> DataFrame:
    """Dynamic spine: every date from min to max of ``date_col`` (opt-in bounds).

    The bounds come from one aggregate row; ``sequence`` is expanded from that
    single row, and its length is the calendar span, not the data size.
    """
    bounds = df_dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return (bounds.where(F.col("lo").isNotNull())
                  .select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date")))
