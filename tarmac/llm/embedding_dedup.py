"""Embedding near-dedup: int8 tile products with error bounds, full precision where they leave doubt.

Unit vectors are quantised to int8 with a scale of their own, and the length of what
rounding took off, ``err``, is kept per vector.  For unit vectors u, v and their
quantised forms U, V

    |u.v - U.V|  <=  err(v) + err(u) * (1 + err(v)),

so a product of the int8 tiles settles every pair but those within that bound of the
threshold; these alone are recomputed from the full vectors in double precision.  The
int8 products are exact: sums of 127 * 127 that fit a float's 24 bits, added up in
double beyond 1040 components.

Vectors are dealt into blocks of bounded size by the hash of a row number, and every
pair of blocks is one group of two packed rows, so the work of a group is the same
however alike the vectors are.  A group returns one row per linked vector, the number
of its links and the least vector it is joined with there, not its pairs; Spark adds
up the links and joins the groups' trees into components.  The number of block pairs
grows with the square of the table: that is what comparing all pairs exactly costs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different lengths do not link; equal vectors
link, also under one id.  A null id is in no ``component_id`` unless its component has
no other id; ``kept`` compares the two as values, null equal to null.  Rows repeating
an id are vectors of their own.  An empty table gives an empty result.  Extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.llm import vectors as V
from tarmac.llm.common import plain, release, saved, table
from tarmac.llm.components import components

THRESHOLD = 0.9
STRIP = 256            # rows of a tile multiplied at once
EXACT_DIM = 1040       # 1040 * 127 * 127 < 2**24
PAIRS = 1 << 16        # pairs recomputed at once
SLACK = 1e-9           # above all rounding of the doubles the bounds are computed in


def quantised(rows: pa.Table) -> pa.Table:
    """Row numbers, vectors, int8 components, scales, errors and lengths of a block."""
    x = V.matrix(rows["vec"], rows.num_rows)
    wide = x.astype(np.float64)
    top = np.abs(wide).max(axis=1, keepdims=True)
    wide /= top                                   # no square overflows or vanishes
    unit = wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    err = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1)) + SLACK
    return pa.table({"row": rows["row"].combine_chunks(), "scale": scale, "err": err,
                     "vec": pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]),
                     "q": pa.FixedSizeListArray.from_arrays(pa.array(q.astype(np.int8).reshape(-1)), x.shape[1])})


class _Block:
    def __init__(self, data: bytes):
        t = V.from_bytes(data)
        n = t.num_rows
        self.row, self.scale, self.err = (t[c].to_numpy() for c in ("row", "scale", "err"))
        self.vec, self.q = V.matrix(t["vec"], n), V.matrix(t["q"], n).astype(np.float32)

    def whole(self, at: np.ndarray) -> np.ndarray:
        x = self.vec[at].astype(np.float64)
        return x / np.abs(x).max(axis=1, keepdims=True)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.shape[1] <= EXACT_DIM:
        return a @ b.T
    return sum((a[:, k:k + EXACT_DIM] @ b[:, k:k + EXACT_DIM].T).astype(np.float64)
               for k in range(0, a.shape[1], EXACT_DIM))


def _linked(a: _Block, b: _Block, at: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of ``a``'s rows ``at``, of ``b``) with cosine >= threshold."""
    products = _products(a.q[at], b.q)
    most = b.err.max()
    # the smallest scaled product a row's pair may have; a little less for the floats' rounding
    least = (threshold - most - a.err[at] * (1 + most)) / a.scale[at]
    least -= 1e-6 * (np.abs(least) + 1)
    i, j = np.nonzero(products * b.scale.astype(np.float32) >= least.astype(np.float32)[:, None])
    near = products[i, j].astype(np.float64) * a.scale[at[i]] * b.scale[j]
    i = at[i]
    doubt = b.err[j] + a.err[i] * (1 + b.err[j])
    link = near - doubt >= threshold
    open_ = np.nonzero(~link & (near + doubt >= threshold))[0]
    for k in range(0, len(open_), PAIRS):
        these = open_[k:k + PAIRS]
        x, y = a.whole(i[these]), b.whole(j[these])
        dot, xx, yy = ((p * q).sum(axis=1) for p, q in ((x, y), (x, x), (y, y)))
        link[these] = dot / np.sqrt(xx * yy) >= threshold
    return i[link], j[link]


def _unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` (the least member of each node's tree) after joining the nodes i and j."""
    while True:
        a, b = root[i], root[j]
        differ = a != b
        if not differ.any():
            return root
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def tile_links(first: bytes, second: bytes | None, threshold: float) -> pa.Table:
    """(row, n, root) of the linked vectors of two blocks, or of one with itself."""
    a = _Block(first)
    b = a if second is None else _Block(second)
    shift = 0 if second is None else len(a.row)
    row = a.row if second is None else np.concatenate([a.row, b.row])
    n, root = np.zeros(len(row), np.int64), np.arange(len(row))
    for k in range(0, len(a.row), STRIP):
        i, j = _linked(a, b, np.arange(k, min(k + STRIP, len(a.row))), threshold)
        if second is None:
            i, j = i[i < j], j[i < j]
        j = j + shift
        n += np.bincount(i, minlength=len(n)) + np.bincount(j, minlength=len(n))
        root = _unite(root, i, j)
    seen = np.nonzero(n)[0]
    return pa.table({"row": row[seen], "n": n[seen], "root": row[root[seen]]})


def links(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(row, n, root) per linked vector and block pair of stored (row, vec), all usable and not zero."""
    n = V.n_blocks(rows)
    packed = saved(V.blocks(rows, n, "row", quantised), "near-blocks")
    other = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("other")
    pairs = packed.select("*", other).select("dim", F.least("block", "other").alias("a"),
                                             F.greatest("block", "other").alias("b"), "block", "data")

    def tile(pair):
        a, b = pair["a"][0].as_py(), pair["b"][0].as_py()
        held = dict(zip(pair["block"].to_pylist(), pair["data"].to_pylist()))
        if a not in held or b not in held:        # a length with few vectors leaves blocks empty
            out = pa.table({c: pa.array([], pa.int64()) for c in ("row", "n", "root")})
        else:
            out = tile_links(held[a], None if a == b else held[b], threshold)
        release()
        return out

    return pairs.groupBy("dim", "a", "b").applyInArrow(tile, "row long, n long, root long")


def near_dedup(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
               threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: id, n_links, component (least id reachable by links), kept."""
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold must be in (0, 1], got {threshold}")
    df = plain(df, id_col, vec_col)
    vec = V.floats(df, vec_col)
    rows = saved(df.select(F.monotonically_increasing_id().alias("row"), df[id_col].alias("id"),
                           F.when(V.usable(vec) & F.exists(vec, lambda x: x != 0), vec).alias("vec")), "near-rows")
    found = saved(links(rows.filter("vec IS NOT NULL").select("row", "vec"), threshold), "near-links")
    counts = found.groupBy("row").agg(F.sum("n").alias("n_links"))
    trees = components(found.filter("row <> root").select(F.col("row").alias("a"), F.col("root").alias("b")), "near")
    trees = saved(trees, "near-components")
    ids = rows.select("row", "id")
    named = (trees.join(ids, trees["node"] == ids["row"]).groupBy("root").agg(F.min("id").alias("least"))
             .select(F.col("root").alias("_root"), "least"))
    member = trees.join(named, trees["root"] == named["_root"]).select(F.col("node").alias("row"), "least",
                                                                     F.lit(True).alias("linked"))
    out = ids.join(counts, "row", "left").join(member, "row", "left")
    return out.select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("linked"), F.col("least")).otherwise(F.col("id")).alias("component")).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component")))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").cast("long").alias("component_id"), "kept")


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT a AS n, a AS m FROM l UNION SELECT l.b AS n, r.m FROM r JOIN l ON l.a = r.n),
c AS (SELECT n, min(m) AS component FROM r GROUP BY n),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT d.vec_id, coalesce(k.n_links, 0) AS n_links, coalesce(c.component, d.vec_id) AS component_id,
       d.vec_id = coalesce(c.component, d.vec_id) AS kept
FROM embeddings d LEFT JOIN c ON c.n = d.vec_id LEFT JOIN k ON k.a = d.vec_id
"""
