"""Suffix-array dedup: passages of at least ``LENGTH`` words that several documents hold.

A suffix is a document from one of its words on.  Only suffixes at minimisers are
kept: positions whose hash of ``GRAM`` words is the least of some ``SPREAD``
neighbouring positions.  The choice depends on the words alone, so every common
passage of ``LENGTH`` words holds a position chosen in all its documents, at most
SPREAD - 1 words after its start.

1. The sparse suffixes are sorted by their first REST = LENGTH - SPREAD + 1 words
   and compared with their neighbours; those equal to none go.
2. Each that is left is extended to the stretch that all passages around it fill,
   SPREAD - 1 words to the left and LENGTH to the right, and the stretches are
   sorted and compared in the same way: an equal one is a repeated passage.
3. The others lie at the edges of passages.  They are extended word by word: every
   run of LENGTH words around them, and around two holders of each repeated stretch
   that begins like them, is sorted and compared.
4. Overlapping repeated runs of a document are joined to maximal spans.

Sorting is by range over (hash, document, position), so the copies of a very common
passage spread over many tasks; a run of equal hashes that crosses tasks is settled
by its ends.  Runs that count as repeated are compared on 128 bits.

Words are runs outside white space and A-Z count as a-z.  Defined results: null,
empty and shorter texts have no spans; a passage repeated inside one document only
is not reported; rows repeating an id are one document (their spans are joined);
null ids form one document; an empty table gives an empty result; extra columns are
ignored; texts are read whole, whatever their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tarmac.llm import wordhash as H
from tarmac.llm.common import map_arrow, plain, saved, small_side, table

LENGTH = 50
SPREAD = 32      # a power of two
GRAM = 8
REST = LENGTH - SPREAD + 1


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """best(x[i:i + width]) for every i with ``width`` values, ``width`` a power of two."""
    step = 1
    while step < width:
        x = best(x[:-step], x[step:]) if len(x) > step else x[:0]
        step *= 2
    return x


def chosen(tokens: np.ndarray, first: np.ndarray, length: int = LENGTH, spread: int = SPREAD) -> np.ndarray:
    """Positions of the minimisers of all texts in one array of words."""
    n = len(tokens)
    grams = H.grams(tokens, GRAM)
    least = _slide(grams, spread, np.minimum)
    end = np.repeat(first[1:], np.diff(first))
    start_ok = np.arange(len(least)) + length <= end[:len(least)]
    least = np.where(start_ok, least, 0)
    # a position is chosen if it is the least of a window that covers it: the greatest such least
    pad = np.zeros(spread - 1, np.uint64)
    over = _slide(np.concatenate([pad, least, pad]), spread, np.maximum)[:n]
    return np.flatnonzero((grams[:len(over)] == over[:len(grams)]) & (over[:len(grams)] > 0))


def _span_hash(tokens: np.ndarray, lo: np.ndarray, hi: np.ndarray, seed: H.Seed) -> np.ndarray:
    """Hash of the words lo..hi - 1, for arrays of bounds."""
    up, down = seed.powers(seed.gram, len(tokens))
    with np.errstate(over="ignore"):
        total = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(tokens * up[:len(tokens)], out=total[1:])
        return H.mix((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def _suffixes(batches):
    """Sparse suffixes: key of their first words, and their stretch with its two hashes."""
    for batch in batches:
        ids = batch.column(0)
        for row, data, offsets in H.pieces(batch.column(1)):
            starts, ends, first = H.bounds(data, offsets)
            tokens = H.words(data, starts, ends)
            at = chosen(tokens, first)
            if not len(at):
                continue
            text = np.searchsorted(first, at, "right") - 1
            lo = np.maximum(at - SPREAD + 1, first[text])
            hi = np.minimum(at + LENGTH, first[text + 1])
            other = H.words(data, starts, ends, H.SEEDS[1])
            cols = [_span_hash(tokens, at, at + REST, H.SEEDS[0]), _span_hash(tokens, lo, hi, H.SEEDS[0]),
                    _span_hash(other, lo, hi, H.SEEDS[1])]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row + text)), pa.array(at - first[text]), pa.array(lo - first[text]),
                 pa.array(hi - first[text]), *[pa.array(c.view(np.int64)) for c in cols]],
                ["id", "pos", "lo", "hi", "key", "h1", "h2"])


def _windows(batches):
    """Every run of LENGTH words around given positions."""
    for batch in batches:
        ids, places = batch.column(0), batch.column(2)
        for row, data, offsets in H.pieces(batch.column(1)):
            starts, ends, first = H.bounds(data, offsets)
            n = len(first) - 1
            part = places.slice(row, n)
            count = np.asarray(pc.list_value_length(part))
            at = np.asarray(part.flatten()) + np.repeat(first[:-1], count)
            text = np.repeat(np.arange(n), count)
            p = (at[:, None] - np.arange(SPREAD)[None, :]).ravel()
            text = np.repeat(text, SPREAD)
            ok = (p >= first[text]) & (p + LENGTH <= first[text + 1])
            p, where = np.unique(p[ok], return_index=True)
            text = text[ok][where]
            if not len(p):
                continue
            cols = [_span_hash(H.words(data, starts, ends, s), p, p + LENGTH, s) for s in H.SEEDS]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row + text)), pa.array(p - first[text]), pa.array(p - first[text] + LENGTH),
                 *[pa.array(c.view(np.int64)) for c in cols]], ["id", "lo", "hi", "h1", "h2"])


def _compare(keys: list[str], others: bool):
    """Compare neighbours in sorted order.

    State 0: the row's key is in two documents; 1: its run meets an edge of the task
    and is not settled; 2: says that a run at an edge is settled; 3 (with ``others``):
    its key is in this document only.  The rows of a run
    wait until a second document comes or the run ends, so what waits is one
    document's.
    """

    def told(rows, state):
        return pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(np.full(rows.num_rows, state, np.int32))], [*rows.schema.names, "state"])

    def run(batches):
        held = settled = tip = None  # waiting rows; key of an open run known to be repeated; last row
        inner = False                # whether the task's first run has ended
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            n = rows.num_rows
            k = [rows.column(c).to_numpy(False) for c in keys]
            ident = rows.column("id").dictionary_encode("encode").indices.to_numpy(False)
            same = np.ones(n - 1, bool)
            for x in k:
                same &= x[1:] == x[:-1]
            start = np.flatnonzero(np.append(True, ~same))
            run_of = np.cumsum(np.append(False, ~same))
            cross = np.bincount(run_of[1:], same & (ident[1:] != ident[:-1]), minlength=len(start)) > 0
            if settled == tuple(x[0] for x in k):
                cross[0] = True
            if not inner and cross[0] and settled is None:
                yield told(rows.slice(0, 1), 2)
            flag = cross[run_of]
            last = run_of == len(start) - 1
            wait = last & ~flag
            edge = (run_of == 0) & ~flag & ~wait & (not inner)
            for mask, state in ((flag, 0), (edge, 1), (~flag & ~edge & ~wait & others, 3)):
                if mask.any():
                    yield told(rows.filter(pa.array(mask)), state)
            held = rows.filter(pa.array(wait)) if wait.any() else None
            settled = tuple(x[-1] for x in k) if cross[-1] else None
            inner = inner or len(start) > 1
            tip = rows.slice(n - 1, 1)
        if held is not None:
            yield told(held, 1)
        elif settled is not None:
            yield told(tip, 2)

    return run


def repeated(rows: DataFrame, keys: list[str], order: str, name: str,
             others: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``keys`` occur under at least two ids, the other rows if asked for).  ``rows`` must be stored."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*keys, "id", order]
    kind = rows.withColumn("state", F.lit(0)).schema
    told = saved(map_arrow(rows.repartitionByRange(n, *by).sortWithinPartitions(*by), _compare(keys, others), kind), name)
    open_ = told.filter("state IN (1, 2)")
    settled = (open_.groupBy(*keys).agg(F.max("state").alias("s"), F.min("id").alias("a"), F.max("id").alias("b"),
                                        F.count_if(F.col("id").isNull()).alias("z"))
               .filter("s = 2 OR a <> b OR (z > 0 AND a IS NOT NULL)").select(*keys))
    edge = told.filter("state = 1")
    common = told.filter("state = 0").unionByName(edge.join(settled, keys, "left_semi").select(*told.columns))
    single = told.filter("state = 3").unionByName(edge.join(settled, keys, "left_anti").select(*told.columns))
    return common.drop("state"), single.drop("state")


def _holders(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Spans with the least and the greatest other document that holds them."""
    least = rows.groupBy(*keys).agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    return rows.join(least, keys).select(
        "id", "lo", "hi", "first_id",
        F.when(F.col("id").eqNullSafe(F.col("first_id")), F.col("last_id"))
        .otherwise(F.col("first_id")).alias("other_id"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal repeated spans: id, start_word, end_word, n_words, first_id, other_id."""
    docs = plain(docs, id_col, text_col).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    sparse = saved(map_arrow(docs, _suffixes, f"id {kind}, pos long, lo long, hi long, key long, h1 long, h2 long"),
                   "suffix-sparse")
    close = saved(repeated(sparse, ["key"], "pos", "suffix-sorted")[0], "suffix-close")
    blocks, alone = repeated(close, ["h1", "h2"], "pos", "suffix-stretches", others=True)
    blocks, alone = saved(blocks, "suffix-blocks"), saved(alone.select("id", "pos", "key"), "suffix-alone")
    # of a repeated stretch two holders stand for all against the suffixes at edges
    place = F.struct("id", "pos", "key")
    two = blocks.groupBy("h1", "h2").agg(F.min(place).alias("x"), F.max(place).alias("y"))
    two = two.select("h1", "h2", F.explode(F.array("x", "y")).alias("z")).select("h1", "h2", "z.*")
    stand = two.join(alone.select("key").distinct(), "key", "left_semi").select("id", "pos")
    edges = saved(alone.select("id", "pos").unionByName(stand).groupBy("id").agg(
        F.sort_array(F.collect_set("pos")).alias("places")), "suffix-edges")
    at = docs.join(small_side(saved(edges.select(F.col("id").alias("_id")), "suffix-edge-ids")),
                   F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    at = at.join(edges.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id"))).select("id", "text", "places")
    near = saved(map_arrow(at, _windows, f"id {kind}, lo long, hi long, h1 long, h2 long"), "suffix-windows")
    runs, _ = repeated(near, ["h1", "h2"], "lo", "suffix-runs")
    long_ = blocks.filter(F.col("hi") - F.col("lo") >= LENGTH)
    found = saved(_holders(long_, ["h1", "h2"]).unionByName(_holders(runs, ["h1", "h2"])), "suffix-found")
    # gaps and islands per document
    order = W.partitionBy("id").orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(W.unboundedPreceding, -1))
    island = found.withColumn("new", F.coalesce(F.col("lo") > reach, F.lit(True)).cast("int"))
    island = island.withColumn("island", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return island.groupBy("id", "island").agg(
        F.min("lo").alias("start_word"), F.max("hi").alias("end_word"), F.min("first_id").alias("first_id"),
        F.min("other_id").alias("other_id")).select(
        "id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
        "first_id", "other_id")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(table(spark, sf_dir, "documents")).withColumnsRenamed(
        {"id": "doc_id", "first_id": "first_doc_id", "other_id": "other_doc_id"})
