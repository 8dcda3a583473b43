"""The corpus pipeline: quality, exact dedup, near dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
its result is written as Parquet and read again before the next one starts, so a
lost executor costs at most work of one stage.  All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import bpe, decontaminate, exact_dedup, jaccard_join, quality
from tarmac.llm.common import saved, table
from tarmac.session import small_arrow_batches

STAGES = [
    ("quality_classifier", quality.stage),
    ("exact_dedup", exact_dedup.stage),
    ("jaccard_join", jaccard_join.stage),
    ("decontamination", decontaminate.stage),
    ("bpe", bpe.stage),
]

# A classifier trained here and the tokenizer have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with small_arrow_batches(spark):
            docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
