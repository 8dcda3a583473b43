"""Bulk scan of landed gzip CSV files into the all-text raw shape.

Load contract:
* comma separated, optional ``"`` quoting (``""`` inside a quoted field is a
  quote), one header line per file that is skipped, gzip;
* columns mapped by position to the fixed 110-column schema (header names are
  ignored, no inference);
* only files matching the landing pattern are read;
* ``''`` and ``'NULL'`` become NULL in every column;
* short rows are padded with NULL, extra fields dropped;
* rows that cannot be parsed (unbalanced quoting) are set aside, the load goes on;
* audit columns: source file (relative to the landing root) and load time.

A gzip file is not splittable: one task per file.  Landing folders are
``year=YYYY/month=MM``; ``recursiveFileLookup`` stops Spark from inferring
``year``/``month`` partition columns that would shadow the data columns
``Year``/``Month`` (names resolve case-insensitively).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.constants import CSV_QUOTE, LANDING_FILE_GLOB, LANDING_PATH_REGEX, NULL_TOKENS
from tarmac.functions.scalar import null_if_token, utc_ntz
from tarmac.session import for_wide_rows
from tarmac.sources.schema import (
    FILE_COLUMNS, FILE_SCHEMA, LOAD_TS_COL, RAW_COLUMNS, RAW_SCHEMA, SOURCE_FILE_COL,
)

CORRUPT_COL = "_corrupt_record"


def csv_options(multiline: bool = True, pattern: str | None = LANDING_FILE_GLOB) -> dict:
    opts = {
        "header": "true",            # skip the header line; names come from the schema
        "enforceSchema": "true",     # positional mapping, header names ignored
        "quote": CSV_QUOTE,
        "escape": CSV_QUOTE,         # "" inside a quoted field
        "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE",        # ragged rows kept (padded / truncated)
        "columnNameOfCorruptRecord": CORRUPT_COL,
        "recursiveFileLookup": "true",
        "compression": "gzip",
        # whether a ragged row is flagged must not depend on the selected columns
        "columnPruning": "false",
    }
    if pattern:
        opts["pathGlobFilter"] = pattern
    return opts


def scan_schema() -> T.StructType:
    return T.StructType(list(FILE_SCHEMA.fields) + [T.StructField(CORRUPT_COL, T.StringType(), True)])


def month_paths(root: str, months: Iterable[tuple[int, int]] | None) -> list[str]:
    """Landing folders to read: all of ``root`` or the selected (year, month)s."""
    root = root.rstrip("/")
    if months is None:
        return [root]
    paths = []
    for year, month in months:
        if not 1 <= int(month) <= 12:
            raise ValueError(f"month must be 1..12, got {month}")
        paths.append(f"{root}/year={int(year)}/month={int(month):02d}")
    return paths


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS,
                columns: Sequence[str] = FILE_COLUMNS) -> DataFrame:
    """Every listed text column equal to one of ``tokens`` becomes NULL (one projection)."""
    cols = set(columns)
    return df.select(*[null_if_token(c, tokens).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _strip_scheme(path: str) -> str:
    return re.sub(_SCHEME, "", path)


def relative_path(path_col: Column, root: str | None) -> Column:
    """File URI with scheme/authority and the landing ``root`` prefix removed."""
    stripped = F.regexp_replace(path_col, _SCHEME, "")
    if not root:
        return stripped
    prefix = _strip_scheme(root).rstrip("/") + "/"
    # the usual forms of a path are cut by their length; the pattern costs much more a row
    known = list(dict.fromkeys([root.rstrip("/") + "/", f"file:{prefix}", f"file://{prefix}"]))
    cut = F
    for head in known:
        cut = cut.when(F.startswith(path_col, F.lit(head)), F.substr(path_col, F.lit(len(head) + 1)))
    return cut.when(F.startswith(stripped, F.lit(prefix)),
                  F.substr(stripped, F.lit(len(prefix) + 1))).otherwise(stripped)


def with_audit(df: DataFrame, root: str | None = None, loaded_at=None) -> DataFrame:
    """Add ``_SOURCE_FILE`` (file path relative to ``root``) and
    ``_LOAD_TIMESTAMP`` (the load's start time, or an injected value)."""
    ts = utc_ntz(F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp"))
    return df.select(
        *[F.col(c) for c in df.columns],
        relative_path(F.col("_metadata.file_path"), root).alias(SOURCE_FILE_COL),
        ts.alias(LOAD_TS_COL),
    )


def _odd_quotes(c: Column) -> Column:
    return (F.length(c) - F.length(F.regexp_replace(c, CSV_QUOTE, ""))) % 2 == 1


def is_reject() -> Column:
    """A record is unparsable when its raw text has unbalanced quoting; ragged
    rows (flagged by the CSV reader too) are good rows."""
    rec = F.col(CORRUPT_COL)
    return F.coalesce(_odd_quotes(rec), F.lit(False))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, unparsable rows); the raw text column is dropped from the good side."""
    # Always true, but keeps one data column in the scan: the CSV reader
    # refuses queries whose only input column is the corrupt-record text
    # (e.g. a bare count over the good rows).
    keep_scan = F.coalesce(F.length(F.col(FILE_COLUMNS[0])), F.lit(0)) >= 0
    good = df.where(~is_reject() & keep_scan).drop(CORRUPT_COL)
    bad = df.where(is_reject() & keep_scan).select(CORRUPT_COL, *[c for c in df.columns
                                                  if c in (SOURCE_FILE_COL, LOAD_TS_COL)])
    return good, bad


def path_matches(root: str, regex: str) -> Column:
    """Whether the file's whole path under ``root`` matches ``regex``.

    A condition on the file's path alone: Spark applies it when it lists the files, and
    opens no others.
    """
    return relative_path(F.col("_metadata.file_path"), root).rlike(f"^(?:{regex})$")


def landed_files(spark: SparkSession, root: str, regex: str = LANDING_PATH_REGEX) -> DataFrame:
    """(path under the root, size, modified) of the files whose path matches; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.where(path_matches(root, regex)).select(
        relative_path(F.col("_metadata.file_path"), root).alias("path"), F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"))


def scan_landing(spark: SparkSession, root: str, months=None, pattern: str | None = LANDING_FILE_GLOB,
                 multiline: bool = True, loaded_at=None, path_regex: str | None = None) -> DataFrame:
    """Landed files -> 110 text columns + corrupt-record text + audit columns.

    ``path_regex`` selects files by their whole path under ``root`` instead of ``pattern``.
    """
    for_wide_rows(spark)
    reader = spark.read.schema(scan_schema()).options(**csv_options(multiline, None if path_regex else pattern))
    df = reader.csv(month_paths(root, months))
    if path_regex:
        df = df.where(path_matches(root, path_regex))
    return with_audit(null_tokens(df), root, loaded_at)


def read_raw(spark: SparkSession, root: str, months=None, pattern: str | None = LANDING_FILE_GLOB,
             multiline: bool = True, loaded_at=None, with_rejects: bool = False, path_regex: str | None = None):
    """Raw table rows (112 columns) from the landing folder.

    Files are chosen by ``pattern`` on their name, or by ``path_regex`` on their whole path
    under ``root`` (``LANDING_PATH_REGEX`` is the load contract's).

    With ``with_rejects=True`` returns ``(raw, rejects)`` where ``rejects``
    holds the unparsable records for a quarantine table.
    """
    if months is not None and not list(months):
        empty = spark.createDataFrame([], RAW_SCHEMA)       # nothing selected
        return (empty, spark.createDataFrame([], f"{CORRUPT_COL} string")) if with_rejects else empty
    good, bad = split_corrupt(scan_landing(spark, root, months, pattern, multiline, loaded_at, path_regex))
    raw = good.select(*RAW_COLUMNS)
    return (raw, bad) if with_rejects else raw
