"""The corpus pipeline, stage by stage, against plain versions of its decisions."""

import hashlib  # noqa: F401

import brute
import corpus_pipeline as P
from odd_rows import SF001
from tarmac.llm import decontaminate as D
from tarmac.llm import quality as Q
from tarmac.llm.common import saved, table


def test_pipeline_decisions(spark):
    docs = table(spark, SF001, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        rows = {r.doc_id: r.text for r in docs.collect()}
        docs = saved(stage(spark, docs, SF001), f"test-{name}")
        kept[name] = (rows, {r.doc_id for r in docs.collect()})
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    before, after = kept["quality_classifier"]
    good = {r.doc_id for r in Q.op6_quality(spark, SF001).filter("predicted = 1").collect()}
    assert after == good
    before, after = kept["exact_dedup"]
    last = {t: max(i for i, u in before.items() if u == t) for t in before.values()}
    assert after == set(last.values()) and len(after) < len(before)
    before, after = kept["jaccard_join"]
    comp = brute.jaccard_components(sorted(before.items()))
    assert after == {c for _, c in comp.values()}
    before, after = kept["decontamination"]
    bad = {r.id for r in D.find(table(spark, SF001, "documents"), table(spark, SF001, "benchmark")).filter(
        "contaminated").collect()}
    assert after == set(before) - bad and bad & set(before)
    before, after = kept["bpe"]
    assert after == set(before) and {"ids", "decoded"} <= set(docs.columns)
    assert P.run(spark, SF001).count() == len(after)


def test_pipeline_sends_small_batches(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tarmac import session
    from tarmac.llm import bpe

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    long = spark.range(64, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    monkeypatch.setattr(P, "table", lambda *a: long)
    monkeypatch.setattr(P, "STAGES", [("sizes", lambda s, docs, d: docs.mapInArrow(sizes, "n long"))])
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    told = [r.n for r in P.run(spark, SF001).collect()]
    assert 64 << 20 <= sum(told) and max(told) <= 2 * session.ARROW_BATCH
    assert spark.conf.get(name) == before
    assert bpe.RUN <= session.ARROW_BATCH      # and the encoder's tables are of no more text than that


def test_pipeline_empty_table(spark, tmp_path):
    docs = table(spark, SF001, "documents").limit(0)
    for _, stage in P.STAGES[1:]:
        docs = saved(stage(spark, docs, SF001), "test-empty")
    assert docs.count() == 0
