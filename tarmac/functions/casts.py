"""Text-to-typed casts used by the staging model.

All of them are built-in column expressions (whole-stage codegen, no Python).
``strict=True``: unparsable text fails the query, as the warehouse cast would, with
or without the session's ANSI mode.  ``strict=False`` turns bad text into NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _cast(col: Column, type_: str, strict: bool) -> Column:
    """``col`` as ``type_``; in strict mode text that does not cast fails the query,
    whatever the session's ANSI setting."""
    value = col.try_cast(type_)
    return F.coalesce(value, _refuse(col, type_)) if strict else value


def _refuse(col: Column, type_: str) -> Column:
    text = F.concat(F.lit(f"cannot cast to {type_}: "), col.cast("string"))
    return F.when(col.isNotNull(), F.raise_error(text).cast(type_))


def cast_fails(col, type_: str) -> Column:
    """Whether a strict cast to int, double or date refuses the text."""
    c = _c(col)
    value = {"int": to_int, "double": to_double, "date": to_date_iso}[type_](c, False)
    return c.isNotNull() & value.isNull()


def to_int(col, strict: bool = True) -> Column:
    """Text to INTEGER.  Integral text takes the fast path; text such as
    ``'1.00'`` goes through an exact decimal and rounds half away from zero."""
    c = _c(col)
    value = F.coalesce(c.try_cast("int"), F.round(c.try_cast("decimal(18,6)"), 0).try_cast("int"))
    return F.coalesce(value, _refuse(c, "int")) if strict else value


def to_double(col, strict: bool = True) -> Column:
    """Text to FLOAT (a 64-bit double, never a 32-bit float)."""
    return _cast(_c(col), "double", strict)


def to_date_iso(col, strict: bool = True) -> Column:
    """Text ``yyyy-MM-dd`` to DATE."""
    c = _c(col)
    value = F.try_to_date(c, "yyyy-MM-dd")
    return F.coalesce(value, _refuse(c, "date")) if strict else value


def flag(col, strict: bool = True) -> Column:
    """``'1.00'``-style indicator to BOOLEAN; NULL or anything else is FALSE."""
    return F.coalesce(to_double(col, strict) == F.lit(1.0), F.lit(False))


def hhmm_pad(col, strict: bool = True) -> Column:
    """HHMM text zero-padded to 4 characters; ``2400`` becomes ``'0000'``."""
    c = _c(col)
    return F.when(to_int(c, strict) == 2400, F.lit("0000")).otherwise(F.lpad(c, 4, "0"))


def hhmm_to_time(col, strict: bool = True, as_time: bool = False) -> Column:
    """HHMM text to a time of day rendered ``HH:mm:ss``; ``2400`` is midnight.
    With ``as_time`` the value is Spark's TIME type instead (requires
    ``spark.sql.timeType.enabled``).

    The value is validated (hour < 24, minute < 60): invalid text fails the
    query in strict mode and is NULL otherwise.  Parsing is plain substring
    arithmetic, so no per-row date formatter is involved.
    """
    c = _c(col)
    padded = F.lpad(c, 4, "0")
    hh = padded.substr(1, 2)
    mi = padded.substr(3, 2)
    valid = (hh.try_cast("int").between(0, 23)) & (mi.try_cast("int").between(0, 59))
    rendered = F.concat(hh, F.lit(":"), mi, F.lit(":00"))
    bad = (F.raise_error(F.concat(F.lit("invalid HHMM time: "), c)).cast("string")
           if strict else F.lit(None).cast("string"))
    text = (F.when(c.isNull(), F.lit(None).cast("string"))
             .when(to_int(c, strict) == 2400, F.lit("00:00:00"))
             .when(valid, rendered)
             .otherwise(bad))
    return text.cast("time") if as_time else text


def date_key(col) -> Column:
    """DATE to the integer key ``yyyyMMdd`` (arithmetic, no string formatting)."""
    d = _c(col)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def day_of_week_sun0(col) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(_c(col)) - 1
