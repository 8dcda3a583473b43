"""Quality classifier by positive-unlabelled learning.

Trusted positives are the training rows labelled 1; every other training row counts
as unlabelled web text (their labels 0 are never shown to the model).  The class
prior is estimated from how a first model ranks the two: the share of the best
positives the unlabelled text keeps up with.  The classifier then minimises the
non-negative unbiased risk

    prior * E_pos[l(g)] + max(0, E_unl[l(-g)] - prior * E_pos[l(-g)])

with the sigmoid loss.  Features describe the whole text and nothing else: how its
bytes, words and lines are made up, scaled by their mean and spread over all training
rows.  They are worked out by Spark for every document.  The weights are fitted on
``SAMPLE`` texts of each kind at most, by least hash of id and text, so the same ones
at every size and order; rows that repeat both are one of them.  The class prior
comes from how all training texts of one half of the hashes rank under a model fitted
on the other half.  The driver gets that sample, the sums and a histogram.

Defined results: a null or empty text has the features of an empty text and a score
like any other; ids may repeat (each row is scored on its own text) or be null (not
used for training, held out like the empty id); without positives or without
unlabelled rows every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.llm import wordhash as H
from tarmac.llm.common import map_arrow, others, plain, release, saved, table, unused

SAMPLE = 12_000       # rows of each kind the model is fitted on
STEPS, RATE, DECAY = 400, 0.03, 1e-4
BINS = 4096           # of a first model's scores, for the class prior
UNIT = 2.0 ** -16     # features are added up in such steps, so their order does not matter
HOLD, FOLDS = 1, 3    # held out: crc32(id as text) mod FOLDS = HOLD

_ASCII = 128
_LEAD = np.zeros(256, bool)
_LEAD[128:192] = True   # bytes that go on with a character
EXTRA = 14
WIDTH = _ASCII + EXTRA


def _ratio(a, b):
    return a / np.maximum(b, 1)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``WIDTH`` numbers for every text."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for row, data, offsets in H.pieces(texts):
        n = len(offsets) - 1
        size = np.diff(offsets)
        owner = np.repeat(np.arange(n), size)
        # share of each ASCII character, other bytes as one, on a root scale
        shown = np.minimum(data, 127).astype(np.int64)
        counts = np.bincount(owner * _ASCII + shown, minlength=n * _ASCII).reshape(n, _ASCII)
        f = np.zeros((n, WIDTH))
        f[:, :_ASCII] = np.sqrt(_ratio(counts, size[:, None]))
        starts, ends, first = H.bounds(data, offsets)
        words = np.diff(first)
        of = H.rows_of(first)
        hashes = H.words(data, starts, ends)
        length = ends - starts

        def per_text(values):
            return np.bincount(of, values, minlength=n)

        pair = np.flatnonzero(of[1:] == of[:-1]) + 1
        same = pair[hashes[pair] == hashes[pair - 1]]
        order = np.lexsort((hashes, of))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
        distinct = np.bincount(of[order][new], minlength=n)
        head, tail = data[starts], data[np.maximum(ends - 1, 0)]
        upper = (head >= 65) & (head <= 90)
        second = data[np.minimum(starts + 1, len(data) - 1)] if len(data) else head
        alnum = ((tail >= 48) & (tail <= 57)) | ((tail | 32) >= 97) & ((tail | 32) <= 122) | (tail >= 128)
        stop = np.isin(tail, np.frombuffer(b".!?", np.uint8))
        lines = np.bincount(owner[data == 10], minlength=n) + 1
        mean = _ratio(per_text(length), words)
        extra = [
            np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(_ratio(per_text(length * length), words) - mean ** 2, 0)),
            _ratio(np.bincount(of[same], minlength=n), words), _ratio(distinct, words),
            _ratio(distinct, np.sqrt(np.maximum(words, 1))), _ratio(per_text(upper), words),
            _ratio(per_text(upper & (second >= 65) & (second <= 90)), words),
            _ratio(per_text(~alnum), words), _ratio(per_text(stop), words), _ratio(words, lines),
            _ratio(per_text(length == 1), words), _ratio(per_text(length > 20), words)]
        f[:, _ASCII:] = np.stack(extra, axis=1)
        out[row:row + n] = f
    return out


def scaled(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Standardised, clipped, and with squares, so that both tails of a feature can count."""
    width = x.shape[1]
    out = np.ones((len(x), 2 * width + 1), np.float32)
    z = out[:, :width]
    np.divide(x - mean.astype(np.float32), spread.astype(np.float32), out=z)
    np.clip(z, -6, 6, out=z)
    np.multiply(z, z / 6, out=out[:, width:-1])
    return out


def _sigmoid(g):
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _fit(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights that minimise the non-negative risk, by Adam over all rows."""
    w = np.zeros(pos.shape[1], np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        sp, su = _sigmoid(pos @ w), _sigmoid(unl @ w)
        slope_p, slope_u = sp * (1 - sp), su * (1 - su)
        negative = su.mean() - prior * sp.mean()
        up = -prior * (slope_p @ pos) / len(pos)
        down = (slope_u @ unl) / len(unl) + up
        # below zero the negative part is overfitted: only that is undone
        grad = up + down if negative >= 0 else -down
        grad = grad + DECAY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w = w.astype(np.float32)
    return w


def estimated_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives in the unlabelled text.

    ``pos`` and ``unl`` count rows by a first model's score, in BINS bins.  In its best
    bins both hold positives only, so the ratio of their shares there is the prior; the
    least upper bound over the thresholds that keep enough positives is taken.
    """
    n, m = pos.sum(), unl.sum()
    if min(n, m) < 2:
        return 0.5  # nothing to estimate it from
    share_p, share_u = np.cumsum(pos[::-1]) / n, np.cumsum(unl[::-1]) / m
    cuts = np.searchsorted(share_p, np.linspace(0.05, 0.95, 19))
    share_p, share_u = share_p[cuts], share_u[cuts]
    slack = np.sqrt(np.log(n + 2) / (2 * n)) + np.sqrt(np.log(m + 2) / (2 * m))
    bound = (share_u + slack) / share_p
    at = int(bound.argmin())
    return float(np.clip(share_u[at] / share_p[at], 0.05, 0.95))


class Model:
    """Weights over features scaled by ``mean`` and ``spread``; without weights every score is 0.5."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        self.mean, self.spread = mean, spread
        self.weights, self.prior = np.zeros(2 * WIDTH + 1), 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(scaled(x, self.mean, self.spread) @ self.weights)


def held_out(id_col: Column) -> Column:
    text = F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")
    return F.pmod(F.crc32(text), F.lit(FOLDS)) == HOLD


def _sums(batches):
    """Per task and feature: sum and sum of squares, in whole UNITs, and the rows."""
    n, total, square = 0, np.zeros(WIDTH), np.zeros(WIDTH)
    for batch in batches:
        x = features(batch.column(0)).astype(np.float64)
        n += len(x)
        total += np.rint(x / UNIT).sum(0)
        square += np.rint(x * x / UNIT).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(range(WIDTH), pa.int32()), pa.array([n] * WIDTH, pa.int64()),
                                      pa.array(total), pa.array(square)], ["feature", "n", "total", "square"])


def scaling(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of every feature over all rows of ``texts``."""
    whole = [F.sum(F.col(c).cast("decimal(38,0)")).cast("double").alias(c) for c in ("total", "square")]
    got = (map_arrow(texts, _sums, "feature int, n long, total double, square double")
           .groupBy("feature").agg(F.sum("n").alias("n"), *whole).collect())  # WIDTH rows
    mean, square = np.zeros(WIDTH), np.zeros(WIDTH)
    for r in got:
        n = max(r["n"], 1)
        mean[r["feature"]], square[r["feature"]] = r["total"] * UNIT / n, r["square"] * UNIT / n
    return mean, np.sqrt(np.maximum(square - mean ** 2, 0)) + 1e-3


def _histogram(rows: DataFrame, good: DataFrame, model: Model) -> dict:
    """Rows of ``rows`` (id, h, text) by score, for positives (True) and the others (False).

    As in the sample, rows that repeat an id and a text are one: the prior is of what is fitted.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)  # weights of fixed size

    def run(batches):
        for batch in batches:
            at = np.minimum(shared.value.score(features(batch.column(2))) * BINS, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at)], ["id", "h", "bin"])

    kind = rows.select("id", "h").withColumn("bin", F.lit(0)).schema
    each = map_arrow(rows.select("id", "h", "text"), run, kind).groupBy("id", "h").agg(F.min("bin").alias("bin"))
    # added up per id before the join, so a hot id is BINS rows at most
    bins = each.groupBy("id", "bin").agg(F.count(F.lit(1)).alias("n"))
    counts = bins.join(good, "id", "left").groupBy(
        F.col("good").isNotNull().alias("good"), "bin").agg(F.sum("n").alias("n")).collect()  # 2 * BINS rows
    out = {True: np.zeros(BINS), False: np.zeros(BINS)}
    for r in counts:
        out[r["good"]][r["bin"]] = r["n"]
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE) -> Model:
    """Model from the training rows of ``docs`` and ``labels`` (id, quality)."""
    train = plain(docs, id_col, text_col).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    train = train.filter(F.col("id").isNotNull() & ~held_out(F.col("id"))).withColumn("h", F.xxhash64("id", "text"))
    good = plain(labels, id_col, "quality").filter("quality = 1").select(F.col(id_col).alias("id")).distinct()
    good = saved(good.withColumn("good", F.lit(True)), "quality-good")
    model = Model(*scaling(train.select("text")))
    # a text written often is one row per task before the join
    ids = train.select("id", "h").distinct().join(good, "id", "left").select(
        "id", "h", F.coalesce("good", F.lit(False)).alias("good"))
    ids = saved(ids, "quality-ids")
    # the same rows at any partitioning: least hashes
    picked = [ids.filter(kind).orderBy("h", "id").limit(sample) for kind in ("good", "NOT good")]
    picked = saved(picked[0].unionByName(picked[1]), "quality-sample")
    rows = train.join(F.broadcast(picked), ["id", "h"])  # 2 * sample rows at most
    kept = map_arrow(rows.select("id", "h", "good", "text"), _numbers(["h", "good"]),
                     "id string, h long, good boolean, x binary")
    # one row per id and text
    got = kept.groupBy("id", "h", "good").agg(F.min("x").alias("x")).orderBy("h", "id").collect()
    kinds = []
    for kind in (True, False):
        mine = [r for r in got if r["good"] == kind]
        x = np.frombuffer(b"".join(r["x"] for r in mine), np.float32).reshape(-1, WIDTH)
        half = np.array([r["h"] & 1 for r in mine], bool)
        kinds.append((scaled(x, model.mean, model.spread), half))
    del got
    (pos, pos_half), (unl, unl_half) = kinds
    if len(pos) and len(unl):
        if (~pos_half).any() and (~unl_half).any():
            model.weights = _fit(pos[~pos_half], unl[~unl_half], 0.5, STEPS // 2)
            counts = _histogram(train.filter(F.col("h").bitwiseAND(1) == 1), good, model)
            model.prior = estimated_prior(counts[True], counts[False])
        model.weights = _fit(pos, unl, model.prior)
    del kinds, pos, unl
    release()  # the driver keeps running for long
    return model


def _numbers(keep: list[str]):
    def run(batches):
        for batch in batches:
            x = features(batch.column("text"))
            blob = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), *[batch.column(c) for c in keep], blob], ["id", *keep, "x"])
    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every row, in place of a column named ``out`` in any case."""
    names = others(docs, out)
    kind = docs.select(*names).withColumn(out, F.lit(0.0)).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)  # weights of fixed size

    def run(batches):
        for batch in batches:
            got = shared.value.score(features(batch.column(text_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], [*names, out])

    return map_arrow(docs.select(*names), run, kind)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(plain(docs, "doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents scored under 0.5 go."""
    own = unused(docs, "quality_score")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")), out=own)
    return scored.filter(F.col(own) >= 0.5).drop(own)
