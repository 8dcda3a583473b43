"""Embedding near-dedup (11) and hard-negative mining (13) against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import SF001
from tarmac.llm import embedding_dedup as D
from tarmac.llm import hard_negatives as H
from tarmac.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_near(rows, threshold=0.9):
    """[(id, links, component, kept)] by comparing all pairs in double precision."""
    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    root = list(range(len(rows)))
    n = [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, v) in enumerate(rows):
        for j in range(i):
            w = rows[j][1]
            if ok(v) and ok(w) and len(v) == len(w):
                x, y = np.array(v, np.float64), np.array(w, np.float64)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    n[i], n[j] = n[i] + 1, n[j] + 1
                    root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k, n[i], least.get(find(i)), k == least.get(find(i))) for i, (k, _) in enumerate(rows)), key=str)


def near(df, **kw):
    return sorted((tuple(r) for r in D.near_dedup(df, **kw).collect()), key=str)


@pytest.fixture(scope="module")
def clustered():
    """Chains, tight groups and pairs close to the threshold on both sides."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(40):
        centre = rng.normal(size=16)
        spread = (0.02, 0.3, 0.5)[i % 3]
        rows += [(centre + rng.normal(size=16) * spread * np.linalg.norm(centre) / 4).tolist() for _ in range(8)]
    a, b = np.zeros(16), np.zeros(16)
    a[0], b[:2] = 1, (0.9, np.sqrt(1 - 0.81))
    for turn in (-1e-3, -1e-6, 1e-6, 1e-3):
        c, s = 0.9 + turn, np.sqrt(1 - (0.9 + turn) ** 2)
        rows += [[0.0] * 14 + [c, s], [0.0] * 14 + [1.0, 0.0]]
    order = rng.permutation(len(rows))
    return [(int(1000 - k), [float(np.float32(x)) for x in rows[k]]) for k in order]


def test_near_dedup_matches_all_pairs(spark, clustered, monkeypatch):
    df = spark.createDataFrame([(i, v, 0) for i, v in clustered], SCHEMA)
    want = plain_near(clustered)
    assert any(r[1] > 3 for r in want) and any(r[1] == 0 for r in want)
    assert near(df) == want
    monkeypatch.setattr(V, "BLOCK_VALUES", 600)       # many blocks and pairs of blocks
    assert near(df) == want
    assert near(df, threshold=0.5) == plain_near(clustered, 0.5)


def test_near_dedup_bounds_hold(clustered):
    import pyarrow as pa
    x = np.array([v for _, v in clustered])
    t = D.quantised(pa.table({"row": np.arange(len(x)), "vec": pa.array(x.tolist(), pa.list_(pa.float64()))}))
    q, scale, err = V.matrix(t["q"], len(x)).astype(float), t["scale"].to_numpy(), t["err"].to_numpy()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    off = np.abs(unit @ unit.T - (q @ q.T) * scale[:, None] * scale)
    assert (off <= err[None] + err[:, None] * (1 + err[None])).all()


ODD = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
       (6, [None, 1.0]), (7, [2.0, 0.0]), (7, [3.0, 0.1]), (None, [5.0, 0.0]), (None, [0.0, 1.0]), (None, None),
       (8, [1.0, 0.0, 0.0]), (9, [3e38, 1e30]), (10, [-1.0, 0.0]), (11, [1e-40, 0.0])]


def test_near_dedup_odd_rows(spark):
    df = spark.createDataFrame([(i, v, 1) for i, v in ODD], SCHEMA).withColumns(
        {"id": F.lit("x"), "row": F.lit(1), "vec": F.lit(None), "n_links": F.lit(2.5)})
    got = near(df)
    assert (0, 5, 0, True) in got and (7, 5, 0, False) in got and (9, 5, 0, False) in got and (None, 5, 0, False) in got
    assert (None, 0, None, True) in got and got.count((None, 0, None, True)) == 2
    for i in (1, 2, 3, 4, 5, 6, 8, 10):
        assert (i, 0, i, True) in got
    assert len(got) == len(ODD)
    assert near(df.limit(0)) == []
    assert near(df.filter("vec_id IN (1, 2)")) == [(1, 0, 1, True), (2, 0, 2, True)]
    with pytest.raises(ValueError, match="threshold"):
        D.near_dedup(df, threshold=0)


def test_near_dedup_one_vector_on_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_VALUES", 512)
    hot = spark.range(0, 900).selectExpr(
        "id AS vec_id", "IF(id % 3 = 0, array(1f, 0f, 0f, 0f), transform(array(1, 2, 3, 4), "
        "x -> CAST(hash(id, x) AS FLOAT) / 2147483647f)) AS embedding")
    got = {r.id: r for r in D.near_dedup(hot).collect()}
    assert len(got) == 900 and all(got[i].n_links >= 299 for i in range(0, 900, 3))
    assert sorted(map(tuple, got.values()), key=str) == plain_near([(r.vec_id, list(r.embedding)) for r in hot.collect()])


def test_op11_on_the_table(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    got = sorted((tuple(r) for r in D.op11_embedding_near_dedup(spark, SF001).collect()), key=str)
    assert got == plain_near([(r.vec_id, list(r.embedding)) for r in rows])


# ---------------------------------------------------------------- hard negatives

def plain_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    rows = [(i, [int(np.floor(256 * float(x))) for x in v], lab) for i, v, lab in rows
            if lab is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for a, (i, v, lab) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), k, other == lab) for b, (k, w, other) in enumerate(rows)
                  if b != a and len(w) == len(v)]
        for ps, p, _ in sorted((s for s in scored if s[2]), key=order)[:positives]:
            fits = sorted((s for s in scored if not s[2] and low * ps <= 100 * s[0] <= high * ps), key=order)
            out += [(i, p, k + 1, s[1], ps, s[0]) for k, s in enumerate(fits[:negatives])]
    return sorted(out, key=str)


def mined(df, anchor):
    return sorted((tuple(r) for r in H.hard_negatives(df, anchor).collect()), key=str)


def test_op13_on_the_table(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in H.op13_hard_negatives(spark, SF001).collect()), key=str)
    assert got == plain_negatives(rows, lambda i: i % 100 == 0) and got


def test_hard_negatives_ties_and_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6)], int(rng.integers(0, 3))) for i in range(400)]
    rows += [(i % 7, v, lab) for i, v, lab in rows[:40]]          # repeated ids, equal vectors
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain_negatives(rows, lambda i: i % 5 == 0)
    assert mined(df, F.col("id") % 5 == 0) == want
    monkeypatch.setattr(V, "BLOCK_VALUES", 700)
    assert mined(df, F.col("id") % 5 == 0) == want


def test_hard_negatives_walks_end_early(monkeypatch):
    """A certified walk reads a small part of a list whose vectors lie in tight groups."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(8, 8)) * 4
    x = (centre[np.arange(8000) % 8] + rng.normal(size=(8000, 8)) * 0.05)
    ids = np.arange(len(x))
    rows = pa.table({"row": ids, "id": ids, "label": ids % 2, "vec": pa.array(x.tolist(), pa.list_(pa.float64()))})
    asks = rows.slice(0, 640).append_column("walker", pa.array(ids[:640])).append_column(
        "low", pa.array(np.full(640, H.LONG.min))).append_column("high", pa.array(np.full(640, H.LONG.max)))
    read = 0
    exact = H.scores

    def counting(a, b, most):
        nonlocal read
        read += len(a) * len(b)
        return exact(a, b, most)

    monkeypatch.setattr(H, "scores", counting)
    got = H.walk(H.walker_block(asks), H.candidate_block(rows), True, 5)
    assert read < 640 * 8000 / 4
    ints = np.floor(256 * x).astype(np.int64)
    for w in (0, 17, 639):
        s = ints @ ints[w]
        s[(ids % 2 != w % 2) | (ids == w)] = -(1 << 60)
        mine = got.filter(pa.compute.equal(got["walker"], w))
        assert mine["row"].to_pylist() == np.lexsort((ids, -s))[:5].tolist()


def test_hard_negatives_odd_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.2], 2), (3, None, 2), (4, [1.0, 1.0], None),
            (5, [0.0, 0.0], 1), (6, [float("nan"), 1.0], 2), (7, [float("-inf"), 1.0], 2), (8, [None, 1.0], 2),
            (None, [0.6, 0.2], 3), (None, [0.6, 0.2], 3), (9, [0.5, 0.2, 0.1], 2), (10, [], 1), (0, [1.0, 0.5], 1),
            (11, [-1.0, -0.5], 1), (12, [0.25, 0.25], 2), (100, [3e30, 1e30], 4), (101, [2e30, 1.0], 4)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit("x"), "Walker": F.lit(1), "id": F.lit("y")})
    small = [r for r in rows if r[0] not in (100, 101)]
    got = mined(df.filter("vec_id IS NULL OR vec_id < 100"), F.col("id").isNotNull())
    assert got == plain_negatives(small, lambda i: i is not None) and got
    far = mined(df, F.col("id") == 100)               # scores beyond a long stay at its end
    assert all(r[4] == H.LONG.max for r in far)
    assert mined(df.limit(0), F.col("id") >= 0) == []
    assert mined(df, F.col("id") == -1) == []


def test_scores_are_exact():
    a = np.array([[1 << 13, 3], [1 << 13, -5]]).astype(np.float64)
    for most, scale in ((1 << 27, 1), (1 << 60, 1 << 20), (1 << 90, 1 << 31)):
        x = a * scale
        got = H.scores(x, x, float(most))
        want = [[min(sum(int(p) * int(q) for p, q in zip(r, s)), H.LONG.max) for s in x] for r in x]
        assert got.tolist() == want
