"""Hard-negative mining over shared candidate lists of anchor clusters (MAXIMUS).

The exact inner-product search behind both steps: who asks (a walker: an anchor, or an
anchor with one of its positives) is clustered by direction with its like.  For a
cluster whose members lie within the angle ``reach`` of its centre, a candidate v at
the angle t from the centre scores at most

    |member| * |v| * cos(max(0, t - reach))

with any member, so a cluster sorts the candidates by |v| * cos(max(0, t - reach))
once, and every member walks that shared list until its k-th best score, or the lower
end of the band it may take from, lies above all that the rest of the list can reach.
The walk is then certified: nothing left can change its answer.

First anchors walk for their positives (rows of their label), then every (anchor,
positive) walks for rows of other labels with scores between 0.3 and 0.9 times the
positive's score.  Walkers and candidates are dealt into blocks of bounded size; a
pair of blocks is one group of two packed rows, where each cluster sorts the block's
candidates and returns at most k rows per walker, and Spark ranks what the blocks
returned.  Scores are exact integers: products are summed as floats or doubles only
where the vectors' lengths prove every partial sum exact, else as Python integers.

Defined results: rows with a null label, a null or empty vector, or null or
non-finite components take no part; vectors of different lengths are no candidates of
one another; a vector of zeros scores 0.  A null id is no anchor; among equal scores it
comes last.  Rows repeating an id are rows of their own, so an id may be its own
positive by another row.  A positive score below 0 leaves no negatives.  Scores beyond
a long are held at its ends.  An empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tarmac.llm import vectors as V
from tarmac.llm.common import plain, release, saved, table

POSITIVES = 5
NEGATIVES = 10
BAND = (30, 90)        # percent of the positive's score
CLUSTER = 64           # walkers a cluster holds on average
ROUNDS = 4             # of k-means over a block's walkers: they only decide how soon walks end
STEPS = (64, 4096)     # candidates of the first and of the longest step of a walk
LONG = np.iinfo(np.int64)


# ------------------------------------------------------------------ packed blocks

def _ints(rows: pa.Table) -> np.ndarray:
    """floor(256 x) as the narrowest type that holds it exactly."""
    x = np.floor(256 * V.matrix(rows["vec"], rows.num_rows).astype(np.float64))
    top = np.abs(x).max(initial=0)
    return x.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.float64)


def _with_ints(rows: pa.Table, ints: np.ndarray, *names: str) -> pa.Table:
    cols = {c: rows[c].combine_chunks() for c in names}
    return pa.table(cols | {"ints": pa.FixedSizeListArray.from_arrays(pa.array(ints.reshape(-1)), ints.shape[1])})


def candidate_block(rows: pa.Table) -> pa.Table:
    return _with_ints(rows, _ints(rows), "row", "id", "label")


def _units(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a vector of zeros has the direction 0."""
    x = ints.astype(np.float64)
    top = np.maximum(np.abs(x).max(axis=1, keepdims=True), 1)
    x /= top
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(size > 0, size, 1), (size * top)[:, 0]


def walker_block(rows: pa.Table) -> pa.Table:
    """The block's walkers in the order of their clusters, with the cluster's number."""
    rows = rows.sort_by("walker")
    ints = _ints(rows)
    unit = _units(ints)[0]
    k = max(1, len(unit) // CLUSTER)
    centre = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        at = (unit @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, at, unit)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(size > 0, total / np.where(size > 0, size, 1), centre)
    out = _with_ints(rows, ints, "walker", "row", "label", "low", "high").append_column("cluster", pa.array(at))
    return out.take(np.argsort(at, kind="stable"))


# ------------------------------------------------------------------ exact scores

def scores(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Inner products of integer rows; ``most`` bounds |a| * |b| and so every partial sum."""
    if most < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = [[int(v) for v in row] for row in b]
    return np.array([[min(max(sum(int(x) * y for x, y in zip(row, other)), LONG.min), LONG.max) for other in whole]
                     for row in a], np.int64).reshape(len(a), len(b))


# ------------------------------------------------------------------ the walk

class _Best:
    """Up to k best (score, then least id, null last) candidates of each member."""

    def __init__(self, members: int, k: int):
        self.k = k
        self.member, self.at, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.worst = np.full(members, LONG.min)      # score of the k-th; the least long while fewer are held

    def add(self, member, at, score, place) -> None:
        member, at, score = (np.concatenate(x) for x in ((self.member, member), (self.at, at), (self.score, score)))
        order = np.lexsort((place[at], ~score, member))      # ~s falls as s grows, without overflow
        member, at, score = member[order], at[order], score[order]
        first = np.searchsorted(member, member)
        rank = np.arange(len(member)) - first
        kept = rank < self.k
        last = rank == self.k - 1
        self.worst[member[last]] = score[last]
        self.member, self.at, self.score = member[kept], at[kept], score[kept]


def walk(walkers: pa.Table, block: pa.Table, same: bool, k: int) -> pa.Table:
    """(walker, row, id, score): each walker's first k of the block's candidates, a superset never."""
    cand, mine = (V.matrix(t["ints"], t.num_rows) for t in (block, walkers))
    row, label = block["row"].to_numpy(), block["label"].to_numpy()
    ids = block["id"].combine_chunks()
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    place = np.empty(len(row), np.int64)                     # rank among equal scores
    place[np.lexsort((row, ids.fill_null(0).to_numpy(), missing))] = np.arange(len(row))
    unit, size = _units(cand)
    cluster = walkers["cluster"].to_numpy()
    cuts = np.flatnonzero(np.diff(cluster, prepend=-1, append=-1))
    parts = []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        best = _walk_cluster(walkers.slice(lo, hi - lo), mine[lo:hi], cand, unit, size, row, label, place, same, k)
        parts.append(pa.table({"walker": walkers["walker"].to_numpy()[lo + best.member], "row": row[best.at],
                               "id": ids.take(pa.array(best.at)), "score": best.score}))
    return pa.concat_tables(parts)


def _walk_cluster(members, ints, cand, unit, size, row, label, place, same, k) -> _Best:
    direction, length = _units(ints)
    centre = direction.sum(axis=0)
    norm = np.linalg.norm(centre)
    centre = centre / norm if norm > 0 else centre
    # a vector of zeros scores 0 everywhere: its angle may be taken as any
    cosines = np.where(length > 0, direction @ centre, 1)
    reach = np.arccos(np.clip(cosines, -1, 1)).max() if norm > 0 else np.pi
    angle = np.arccos(np.clip(unit @ centre, -1, 1))
    # rounding moves an angle by less than 1e-7; what it adds to a bound is far below 1e-6 of |v|
    bound = size * (np.cos(np.maximum(0, angle - reach - 1e-6)) + 1e-6)
    order = np.argsort(-bound, kind="stable")
    most = float(size.max(initial=0)) * length
    want, own = members["label"].to_numpy(), members["row"].to_numpy()
    low, high = members["low"].to_numpy(), members["high"].to_numpy()
    best, active = _Best(len(ints), k), np.flatnonzero(low <= high)
    at, step = 0, STEPS[0]
    while at < len(order) and len(active):
        floor = np.maximum(best.worst[active], low[active]).astype(np.float64)
        active = active[bound[order[at]] * length[active] * (1 + 1e-9) >= floor]
        if not len(active):
            break
        part = order[at:at + step]
        got = scores(ints[active], cand[part], float(most[active].max()))
        least = np.maximum(best.worst[active], low[active])[:, None]
        fits = (got >= least) & (got <= high[active][:, None])
        fits &= (label[part][None] == want[active][:, None]) == same
        m, c = np.nonzero(fits)
        m = active[m]
        other = row[part[c]] != own[m]
        if other.any():
            best.add(m[other], part[c][other], got[fits][other], place)
        at, step = at + step, min(2 * step, STEPS[1])
    return best


# ------------------------------------------------------------------ Spark

def nearest(walkers: DataFrame, packed: DataFrame, n: int, same: bool, k: int, name: str) -> DataFrame:
    """(walker, row, id, score, rank): the first k candidates of every walker.

    ``walkers`` (stored): walker, row, label, vec, low, high; ``packed``: ``n`` candidate
    blocks.  Candidates have the walker's label if ``same``, else another one, a score
    from low to high, and are other rows.
    """
    m = V.n_blocks(walkers)
    asked = V.blocks(walkers, m, "walker", walker_block, "pack")
    asked = asked.select("dim", "pack", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"),
                         F.lit(0).alias("kind"), "data")
    held = packed.select("dim", F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("pack"), "block",
                         F.lit(1).alias("kind"), "data")

    def task(pair):
        by = dict(zip(pair["kind"].to_pylist(), pair["data"].to_pylist()))
        if len(by) < 2:                       # a length with few vectors leaves blocks empty
            out = pa.table({c: pa.array([], pa.int64()) for c in ("walker", "row", "id", "score")})
        else:
            out = walk(V.from_bytes(by[0]), V.from_bytes(by[1]), same, k)
        release()
        return out

    found = asked.unionByName(held).groupBy("dim", "pack", "block").applyInArrow(
        task, "walker long, row long, id long, score long")
    first = Window.partitionBy("walker").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return saved(found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k), name)


def _share(score: Column, percent: int, up: bool) -> Column:
    """floor or ceiling of percent/100 of a long, exactly."""
    cents = F.lit(percent).cast("decimal(3,0)") * score.cast("decimal(19,0)") / F.lit(100).cast("decimal(3,0)")
    return (F.ceil(cents) if up else F.floor(cents)).cast("long")


def hard_negatives(df: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   band: tuple[int, int] = BAND) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` says which rows are anchors, over the columns ``id`` and ``label``.
    """
    df = plain(df, id_col, vec_col, label_col)
    vec = V.floats(df, vec_col)
    rows = df.filter(df[label_col].isNotNull() & V.usable(vec) & (F.size(vec) > 0)).select(
        F.monotonically_increasing_id().alias("row"), df[id_col].cast("long").alias("id"),
        df[label_col].cast("long").alias("label"), vec.alias("vec"))
    rows = saved(rows, "negatives-rows")
    n = V.n_blocks(rows)
    packed = saved(V.blocks(rows, n, "row", candidate_block), "negatives-blocks")
    anchors = rows.filter(anchor)
    asks = saved(anchors.select(F.col("row").alias("walker"), "row", "label", "vec",
                                F.lit(LONG.min).alias("low"), F.lit(LONG.max).alias("high")), "negatives-anchors")
    best = nearest(asks, packed, n, True, positives, "negatives-positives")
    score = F.col("score")
    pairs = anchors.select("row", "id", "label", "vec").withColumnRenamed("id", "anchor_id").join(
        best.select(F.col("walker").alias("row"), F.col("id").alias("positive_id"), score.alias("positive_score"),
                    _share(score, band[0], True).alias("low"), _share(score, band[1], False).alias("high")), "row")
    pairs = saved(pairs.withColumn("walker", F.monotonically_increasing_id()), "negatives-pairs")
    found = nearest(pairs.select("walker", "row", "label", "vec", "low", "high"), packed, n, False, negatives,
                    "negatives-found")
    return pairs.select("walker", "anchor_id", "positive_id", "positive_score").join(found, "walker").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def relabelled(df: DataFrame) -> DataFrame:
    """``embeddings`` with the label of every seventh id moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return plain(df, "vec_id", "embedding", "label").withColumn("label", moved)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(table(spark, sf_dir, "embeddings")), F.col("id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""
