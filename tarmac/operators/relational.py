"""Relational operators: filters, projections, distinct, union, dimension joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir

# Most rows of a one-column side that is broadcast on demand (8-byte hashes).
MAX_BROADCAST_ROWS = 1_000_000


def filter_carriers(df: DataFrame, column: str, codes: Sequence[str]) -> DataFrame:
    """Keep rows whose ``column`` is in ``codes`` (an IN-list the scan can push)."""
    return df.where(F.col(column).isin(*codes))


def rename_cast(df: DataFrame, spec: Sequence[tuple[str, Column]]) -> DataFrame:
    """One projection of ``(output name, expression)`` pairs."""
    return df.select(*[expr.alias(name) for name, expr in spec])


def distinct_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``SELECT DISTINCT cols``: map-side partial aggregation collapses
    duplicates (and hot keys) before anything shuffles."""
    return df.select(*cols).distinct()


def airports_union(df: DataFrame, roles: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """UNION (distinct) of one projection per role, in a single scan.

    Each input row is unpivoted into one struct per role inside the scan
    stage, then one distinct aggregates them: equal to
    ``SELECT DISTINCT r1 UNION SELECT DISTINCT r2`` without scanning twice.
    """
    names = list(next(iter(roles.values())).keys())
    structs = [F.struct(*[F.col(src).alias(dst) for dst, src in mapping.items()])
               for mapping in roles.values()]
    return (df.select(F.explode(F.array(*structs)).alias("_r"))
              .select(*[F.col(f"_r.{n}").alias(n) for n in names])
              .distinct())


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` checkpointed once (shared folder) and broadcast when it has at most ``max_rows`` rows.

    The count is a partial aggregate over the stored rows.  Meant for narrow
    sides (a key of a few bytes); larger ones are joined by shuffle.
    """
    ensure_checkpoint_dir(df.sparkSession)
    saved = df.checkpoint(eager=True)
    return F.broadcast(saved) if saved.count() <= max_rows else saved


def join_dim(fact: DataFrame, dim: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)`` adding ``cols`` from the dimension.

    Nothing runs while planning and nothing is forced: Spark broadcasts the
    dimension when its bytes (file sizes, or AQE's run-time statistics) are under
    its threshold, and else joins by shuffle with AQE splitting hot keys.
    Non-unique dimension keys fan out exactly as in SQL.
    """
    d = dim.select(F.col(key).alias("_dk"), *cols)
    return fact.join(d, fact[key] == d["_dk"], "left").drop("_dk")
