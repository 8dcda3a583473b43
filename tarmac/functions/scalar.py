"""Scalar and aggregate column builders shared by the models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.constants import CENSUS_REGIONS, REGION_DEFAULT


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- conditionals

def lookup(col, mapping: Mapping[str, str], default: str | None) -> Column:
    """Simple CASE: map each key to its value, anything else (NULL too) to default."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    dflt = F.lit(default)
    return dflt if expr is None else expr.otherwise(dflt)


def census_region(col) -> Column:
    """State code to US Census region; NULL or unlisted gives the default."""
    c = _c(col)
    expr = None
    for region, states in CENSUS_REGIONS:
        cond = c.isin(*states)
        expr = F.when(cond, F.lit(region)) if expr is None else expr.when(cond, F.lit(region))
    return expr.otherwise(F.lit(REGION_DEFAULT))


def null_if_token(col, tokens: Iterable[str]) -> Column:
    """NULL when the text equals one of ``tokens`` (the load's NULL_IF list)."""
    c = _c(col)
    return F.when(~c.isin(*tokens), c)


# ---------------------------------------------------------------- keys

def surrogate_key(*cols, sep: str = "-") -> Column:
    """MD5 over the separator-joined text of ``cols``, each NULL read as ''.

    NULLs are replaced *before* joining: ``concat_ws`` alone would skip them
    and shift the separators.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


# ---------------------------------------------------------------- arithmetic

def pct(part, whole, scale: int) -> Column:
    """``round(part * 100.0 / whole, scale)`` in exact decimal arithmetic,
    returned as double.  ``whole`` must be non-zero (a group count)."""
    num = _c(part).cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    return F.round(num / _c(whole).cast("decimal(20,0)"), scale).cast("double")


def pct_of(part, total, scale: int) -> Column:
    """``round(part * 100.0 / nullif(total, 0), scale)`` in double arithmetic;
    a zero or NULL total gives NULL instead of an error."""
    return F.round(_c(part) * F.lit(100.0) / F.nullif(_c(total), F.lit(0.0)), scale)


# ---------------------------------------------------------------- aggregates

def count_where(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)`` (NULL predicate counts 0)."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("long")


def avg_where(x, pred: Column, scale: int) -> Column:
    """``ROUND(AVG(CASE WHEN pred THEN x END), scale)``."""
    return F.round(F.avg(F.when(pred, _c(x))), scale)


def p_cont(x, quantiles: Sequence[float]) -> Column:
    """Exact interpolated percentiles (percentile_cont) of ``x`` in ONE
    aggregate buffer; returns an array aligned with ``quantiles``.  NULLs
    are ignored.  Partial aggregation is supported, so the map-side buffer is
    a value->count map per group, not the group's rows; it grows with the distinct
    values, so add up fractional measures per value first (see the marts)."""
    return F.percentile(_c(x), F.array(*[F.lit(float(q)) for q in quantiles]))


# ---------------------------------------------------------------- text / time

def truncate_text(col, n: int = 200, suffix: str = "...") -> Column:
    """First ``n`` characters without trailing white space, plus ``suffix`` when
    the line was longer.  The line end counts as a character of the line, so a
    text of exactly ``n`` characters, which had one, gets the suffix too."""
    c = _c(col)
    head = F.regexp_replace(F.substring(c, 1, n), r"\s+$", "")
    return F.when(F.length(c) >= n, F.concat(head, F.lit(suffix))).otherwise(head)


def utc_ntz(ts) -> Column:
    """A timestamp's clock time in UTC, whatever the session's time zone."""
    return F.to_utc_timestamp(_c(ts), F.current_timezone()).cast("timestamp_ntz")


def utc_iso(ts) -> Column:
    """Timestamp in UTC as ``yyyy-MM-ddTHH:mm:ssZ``, whatever the session's time zone."""
    return F.date_format(utc_ntz(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_offset_iso(ts) -> Column:
    """Timestamp in UTC as ``yyyy-MM-ddTHH:mm:ss[.ffffff]+00:00``."""
    t = utc_ntz(ts)
    micros = F.date_format(t, "SSSSSS")
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00"))
