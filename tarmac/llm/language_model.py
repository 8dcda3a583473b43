"""LM scoring: an interpolated modified Kneser-Ney model counted in Spark.

Counting: every task sums the word pairs of its texts (each text opened by a start
mark and closed by an end token), Spark adds them up per shard, and one task per
shard writes its pairs as a sorted hash array with counts beside it.  What the
pairs say about words (count, distinct left neighbours, and how many followers a
word has once, twice or more) is summed by Spark into word arrays of the same form.
Shards follow the word before and a part of the word after, so the followers of a
very common word spread over several shards.

Scoring: workers memory-map the arrays from the shared folder (a store without
local paths is copied to the worker first) and look up whole batches of sorted
hashes.  P(w | v) = max(c(vw) - D(c), 0) / c(v) + gamma(v) P(w), with P(w) from the
numbers of distinct left neighbours, interpolated with 1 / (V + 1) for any token
not seen.  The three discounts of each level come from its counts of counts.

The order is two: arrays of three-word sequences do not fit the disk the check tool
grants (README).

Defined results: a null text is the empty one, which is its end token alone; ids may
be null (their text form is empty) or repeat (each row is scored on its own);
without training rows every probability is one in V + 1 = 1, so scores are 0; extra
columns pass through ``score`` unchanged; texts of any length are read whole.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.llm import wordhash as H
from tarmac.llm.common import map_arrow, others, plain, saved, table
from tarmac.session import ensure_checkpoint_dir, scratch_path, ship_package

HOLD, FOLDS = 1, 5          # held out: crc32(id as text) mod FOLDS = HOLD
START, END = np.uint64(0x5D1AF5A1B7C3E94D), np.uint64(0x2C9E77D0A3B1F685)
SPREAD = 8                  # shards over which one word's followers spread
MANY = 255                  # counts from here on are in arrays of their own; one byte holds the others
PAIRS = 3_000_000           # pairs a task holds before it passes their sums on
RANGES = 16                 # parts, by the word before, in which held pairs are summed and passed on


def sequences(texts: pa.Array):
    """Per piece: (first row, word before, word, first token of every text and the end)."""
    for row, data, offsets in H.pieces(texts):
        starts, ends, first = H.bounds(data, offsets)
        words, n = H.words(data, starts, ends), len(first) - 1
        after = np.full(len(words) + n, END, np.uint64)
        after[np.arange(len(words)) + H.rows_of(first)] = words
        before = np.empty_like(after)
        before[1:] = after[:-1]
        first = first + np.arange(n + 1)
        before[first[:-1]] = START
        yield row, before, after, first


def pair_key(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return H.mix(before * np.uint64(0x9E3779B97F4A7C15) + after)


def pair_shard(before: np.ndarray, after: np.ndarray, shards: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (H.mix(before + (after & np.uint64(SPREAD - 1))) % np.uint64(shards)).astype(np.int32)


def _summed(before: np.ndarray, after: np.ndarray, count: np.ndarray):
    order = np.lexsort((after, before))
    before, after = before[order], after[order]
    new = np.ones(len(order), bool)
    new[1:] = (before[1:] != before[:-1]) | (after[1:] != after[:-1])
    at = np.flatnonzero(new)
    return before[at], after[at], np.add.reduceat(count[order], at) if len(at) else count[:0]


def _count(shards: int):
    """Tasks' part of the counting: summed pairs, in order of the word before.

    What is held is sorted by that word, so it is cut into ranges of it; only one
    range is copied, sorted and handed to Spark at a time.
    """
    edges = np.arange(1, RANGES, dtype=np.uint64) * np.uint64((1 << 64) // RANGES)

    def out(held):
        cuts = [[0, *np.searchsorted(b, edges), len(b)] for b, _, _ in held]
        for k in range(RANGES):
            parts = [[x[cut[k]:cut[k + 1]] for x in piece] for piece, cut in zip(held, cuts)]
            b, a, c = _summed(*(np.concatenate(x) for x in zip(*parts)))
            if len(b):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair_shard(b, a, shards)), pa.array(b.view(np.int64)), pa.array(a.view(np.int64)),
                     pa.array(c)], ["shard", "v", "w", "c"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for _, before, after, _ in sequences(batch.column(0)):
                b, a, c = _summed(before, after, np.ones(len(after), np.int64))
                held.append((b, a, c))
                n += len(b)
                if n > PAIRS:
                    yield from out(held)
                    held, n = [], 0
        if held:
            yield from out(held)

    return run


def _write(root: str, name: str, values: np.ndarray) -> None:
    """Write an array under the shared folder; a task that runs again replaces it whole."""
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(f"{root}/{name}") if ":" in root else (
        fs.LocalFileSystem(), f"{root}/{name}")
    store.create_dir(os.path.dirname(path), recursive=True)
    with tempfile.NamedTemporaryFile() as unique:
        part = f"{path}.{os.path.basename(unique.name)}"
    with store.open_output_stream(part) as f:
        f.write(np.ascontiguousarray(values).tobytes())
    store.move(part, path)


def _mapped(root: str, name: str, kind) -> np.ndarray:
    """Memory map of a written array."""
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(f"{root}/{name}") if ":" in root else (
        fs.LocalFileSystem(), f"{root}/{name}")
    if not isinstance(store, fs.LocalFileSystem):
        local = os.path.join(tempfile.gettempdir(), f"{os.path.basename(root)}-{name}")
        if not os.path.exists(local):
            with store.open_input_stream(path) as f, open(f"{local}.{os.getpid()}", "wb") as g:
                g.write(f.read())
            os.replace(f"{local}.{os.getpid()}", local)
        path = local
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


WORD_COLUMNS = ["c", "left", "f1", "f2", "f3", "e3", "e4"]


def _word_rows(h: np.ndarray, **columns) -> pa.RecordBatch:
    zero = np.zeros(len(h), np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), *[pa.array(columns.get(c, zero)) for c in WORD_COLUMNS]], ["h", *WORD_COLUMNS])


def _write_pairs(root: str):
    """One shard: its sorted pair array, and what its pairs say about words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        shard = rows.column("shard")[0].as_py()
        v, w, c = (rows.column(x).to_numpy() for x in ("v", "w", "c"))
        v, w = v.view(np.uint64), w.view(np.uint64)
        key = pair_key(v, w)
        order = np.argsort(key)
        key, count = key[order], c[order]
        _write(root, f"pair-keys-{shard}", key)
        _write(root, f"pair-counts-{shard}", np.minimum(count, MANY).astype(np.uint8))
        many = count >= MANY
        _write(root, f"many-keys-{shard}", key[many])
        _write(root, f"many-counts-{shard}", count[many])
        words, at = np.unique(w, return_inverse=True)
        yield _word_rows(words, c=np.bincount(at, c).astype(np.int64), left=np.bincount(at).astype(np.int64))
        words, at = np.unique(v, return_inverse=True)
        tell = {name: np.bincount(at, flag, minlength=len(words)).astype(np.int64) for name, flag in
                (("f1", c == 1), ("f2", c == 2), ("f3", c > 2), ("e3", c == 3), ("e4", c == 4))}
        yield _word_rows(words, **tell)

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple:
    """Discounts of counts 1, 2 and 3 or more from the counts of counts."""
    if not (n1 and n2 and n3 and n4):
        return (0.5, 0.75, 0.9)  # too little text for estimates
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(found))


def _discount(count: np.ndarray, d: tuple) -> np.ndarray:
    return np.where(count > 2, d[2], np.where(count > 1, d[1], np.where(count > 0, d[0], 0.0)))


def _write_words(root: str, meta: dict):
    """One shard of the word arrays: hash, count, P(w), and the mass left to P(w) after it."""
    d, low = meta["pair_discounts"], meta["word_discounts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        part = rows.column("part")[0].as_py()
        h = rows.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        c, left, f1, f2, f3 = (rows.column(x).to_numpy()[order] for x in WORD_COLUMNS[:5])
        total = np.where(h[order] == START, meta["texts"], c)
        p = (left - _discount(left, low)) / meta["pairs"] + meta["spare"] / (meta["V"] + 1)
        mass = (d[0] * f1 + d[1] * f2 + d[2] * f3) / np.maximum(total, 1)
        for name, values, kind in (("hash", h[order], np.uint64), ("count", c, np.float64), ("p", p, np.float64),
                                   ("mass", np.where(total > 0, mass, 1), np.float64)):
            _write(root, f"word-{name}-{part}", values.astype(kind))
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32())], ["part"])

    return run


class Model:
    """Numbers of a model and the shared folder that holds its arrays."""

    def __init__(self, root: str, shards: int, meta: dict):
        self.root, self.shards, self.meta = root, shards, meta


def fit(train: DataFrame, text_col: str = "text", shards: int | None = None) -> Model:
    """Count ``train`` and write the arrays."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = scratch_path(spark, "lm")
    pairs = map_arrow(train.select(text_col), _count(shards), "shard int, v long, w long, c long")
    # one exchange serves the sum and the shards; texts were summed per task before it
    pairs = pairs.repartition(shards, "shard").groupBy("shard", "v", "w").agg(F.sum("c").alias("c"))
    kind = "h long, " + ", ".join(f"{c} long" for c in WORD_COLUMNS)
    told = pairs.groupBy("shard").applyInArrow(_write_pairs(root), kind)
    words = saved(told.groupBy("h").agg(*[F.sum(c).alias(c) for c in WORD_COLUMNS]), "lm-words")
    of = [F.count_if(F.col("left") == i).alias(f"l{i}") for i in (1, 2, 3, 4)]
    t = words.agg(F.sum("c").alias("N"), F.count_if(F.col("c") > 0).alias("V"), F.sum("left").alias("pairs"),
                  F.sum("f1").alias("f1"), F.sum("f2").alias("f2"), F.sum("e3").alias("e3"), F.sum("e4").alias("e4"),
                  F.sum(F.when(F.col("h") == int(END.view(np.int64)), F.col("c"))).alias("texts"),
                  F.count_if(F.col("left") > 2).alias("lm"), *of).first()
    t = {k: v or 0 for k, v in t.asDict().items()}
    low = discounts(t["l1"], t["l2"], t["l3"], t["l4"])
    pairs_n = max(1, t["pairs"])
    meta = {"N": t["N"], "V": t["V"], "pairs": pairs_n, "texts": t["texts"], "word_discounts": low,
            "pair_discounts": discounts(t["f1"], t["f2"], t["e3"], t["e4"]),
            "spare": (low[0] * t["l1"] + low[1] * t["l2"] + low[2] * t["lm"]) / pairs_n if t["N"] else 1.0}
    part = F.pmod("h", F.lit(shards)).cast("int")
    (words.withColumn("part", part).groupBy("part").applyInArrow(_write_words(root, meta), "part int")
     .write.format("noop").mode("overwrite").save())
    return Model(root, shards, meta)


class Tables:
    """A worker's view of the arrays; files are mapped when first needed."""

    def __init__(self, root: str, shards: int):
        self.root, self.shards, self.maps = root, shards, {}

    def _map(self, name: str, kind) -> np.ndarray:
        if name not in self.maps:
            try:
                self.maps[name] = _mapped(self.root, name, kind)
            except FileNotFoundError:  # a shard that got no row
                self.maps[name] = np.zeros(0, kind)
        return self.maps[name]

    def find(self, keys: np.ndarray, shard: np.ndarray, index: str, values: list) -> list[np.ndarray]:
        """For sorted distinct ``keys``: the value columns (name, kind, default)."""
        out = [np.full(len(keys), default, kind) for _, kind, default in values]
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            mine = order[cuts[s]:cuts[s + 1]]
            have = self._map(f"{index}-{s}", np.uint64)
            if not len(have):
                continue
            at = np.minimum(np.searchsorted(have, keys[mine]), len(have) - 1)
            hit = have[at] == keys[mine]
            for (name, kind, _), column in zip(values, out):
                column[mine[hit]] = self._map(f"{name}-{s}", kind)[at[hit]]
        return out


@lru_cache(maxsize=2)
def tables(root: str, shards: int) -> Tables:
    return Tables(root, shards)


def score_texts(model: Model, texts: pa.Array):
    """Per text: tokens, known tokens, log10 of the base and of the model."""
    meta, found = model.meta, tables(model.root, model.shards)
    d = meta["pair_discounts"]
    unseen = meta["spare"] / (meta["V"] + 1)
    n = len(texts)
    tokens, known, base, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    for row, before, after, first in sequences(texts):
        words, at = np.unique(after, return_inverse=True)
        part = (words.view(np.int64) % model.shards).astype(np.int32)
        count, p, mass = found.find(words, part, "word-hash", [
            ("word-count", np.float64, 0), ("word-p", np.float64, unseen), ("word-mass", np.float64, 1)])
        start = np.array([START])
        _, _, mass0 = found.find(start, (start.view(np.int64) % model.shards).astype(np.int32), "word-hash", [
            ("word-count", np.float64, 0), ("word-p", np.float64, unseen), ("word-mass", np.float64, 1)])
        key, pos, of = np.unique(pair_key(before, after), return_index=True, return_inverse=True)
        shard = pair_shard(before[pos], after[pos], model.shards)
        together, = found.find(key, shard, "pair-keys", [("pair-counts", np.uint8, 0)])
        many, together = together == MANY, together.astype(np.float64)
        together[many], = found.find(key[many], shard[many], "many-keys", [("many-counts", np.int64, 0)])
        together = together[of]
        c = count[at]
        total, left = np.empty(len(c)), np.empty(len(c))
        total[1:], left[1:] = c[:-1], mass[at][:-1]
        total[first[:-1]], left[first[:-1]] = meta["texts"], mass0[0]
        prob = (together - _discount(together, d)) / np.maximum(total, 1) + left * p[at]
        plain_ = np.log10((c + 0.5) / (meta["N"] + 0.5 * (meta["V"] + 1)))
        size = len(first) - 1
        tokens[row:row + size] = np.diff(first)
        known[row:row + size] = np.add.reduceat(c > 0, first[:-1], dtype=np.int64)
        base[row:row + size] = np.add.reduceat(plain_, first[:-1])
        score[row:row + size] = np.add.reduceat(np.log10(prob), first[:-1])
    return tokens, known, base, score


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score and score, in place of columns so named in any case."""
    new = ["n_tokens", "n_known", "base_score", "score"]
    names = others(docs, *new)
    kind = docs.select(*names).withColumns({
        "n_tokens": F.lit(0).cast("long"), "n_known": F.lit(0).cast("long"),
        "base_score": F.lit(0.0), "score": F.lit(0.0)}).schema

    def run(batches):
        for batch in batches:
            got = score_texts(model, batch.column(text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, got)], [*names, *new])

    return map_arrow(docs.select(*names), run, kind)


def held_out(id_col: Column) -> Column:
    text = F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")
    return F.pmod(F.crc32(text), F.lit(FOLDS)) == HOLD


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = plain(table(spark, sf_dir, "documents"), "doc_id", "text")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.meta["N"]).cast("long").alias("train_tokens"), "base_score", "score")


# The folds' crc32 is worked out bit by bit; '< >' and '</ >' hold a space, so no word equals them.
ORACLE = r"""
WITH ids AS (SELECT DISTINCT doc_id, coalesce(doc_id::VARCHAR, '') AS id FROM documents),
crc AS (SELECT doc_id, xor(list_reduce(
          [4294967295::BIGINT] || list_transform(string_split(id, ''), lambda c: ascii(c)::BIGINT),
          lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                   lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 5 = 1 AS held_out
        FROM ids),
d AS (SELECT doc_id, held_out, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') || ['</ >'] AS ws
      FROM documents JOIN crc USING (doc_id)),
t AS (SELECT doc_id, held_out, unnest(ws) AS w, unnest(['< >'] || ws[:-2]) AS v FROM d),
c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY 1),
vw AS (SELECT v, w, count(*) AS c FROM t WHERE NOT held_out GROUP BY 1, 2),
num AS (SELECT (SELECT sum(c) FROM c) AS n, (SELECT count(*) FROM c) AS vocab, (SELECT count(*) FROM vw) AS pairs,
        (SELECT count(*) FROM d WHERE NOT held_out) AS texts),
lw AS (SELECT w, count(*) AS l FROM vw GROUP BY 1),
told AS (SELECT 'vw' AS k, count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2, count(*) FILTER (c = 3) AS n3,
           count(*) FILTER (c = 4) AS n4 FROM vw
         UNION ALL SELECT 'lw', count(*) FILTER (l = 1), count(*) FILTER (l = 2), count(*) FILTER (l = 3),
           count(*) FILTER (l = 4) FROM lw),
disc AS (SELECT k, CASE WHEN least(n1, n2, n3, n4) = 0 THEN [0.5::DOUBLE, 0.75, 0.9] ELSE
           [least(greatest(1 - 2 * y * n2 / n1, 0.05), 0.95), least(greatest(2 - 3 * y * n3 / n2, 0.05), 1.95),
            least(greatest(3 - 4 * y * n4 / n3, 0.05), 2.95)] END AS off
         FROM (SELECT *, n1::DOUBLE / (n1 + 2 * n2) AS y FROM told)),
dv AS (SELECT off FROM disc WHERE k = 'vw'), dl AS (SELECT off FROM disc WHERE k = 'lw'),
spare AS (SELECT sum(off[least(l, 3)]) / (SELECT pairs FROM num) AS spare FROM lw, dl),
p1 AS (SELECT w, (l - off[least(l, 3)]) / pairs + spare / (vocab + 1) AS p FROM lw, dl, num, spare),
mass AS (SELECT v, sum(off[least(vw.c, 3)]) AS m, CASE WHEN v = '< >' THEN (SELECT texts FROM num) ELSE any_value(c.c) END AS total
         FROM vw LEFT JOIN c ON c.w = vw.v, dv GROUP BY v)
SELECT t.doc_id, t.held_out, count(*) AS n_tokens, count(c.c) AS n_known, any_value(n)::BIGINT AS train_tokens,
  sum(log10((coalesce(c.c, 0) + 0.5) / (n + 0.5 * (vocab + 1)))) AS base_score,
  sum(log10(coalesce((vw.c - off[least(vw.c, 3)]) / total, 0) + coalesce(m / total, 1) * coalesce(p, spare / (vocab + 1)))) AS score
FROM t, num, dv, spare LEFT JOIN c ON c.w = t.w LEFT JOIN vw ON vw.v = t.v AND vw.w = t.w
  LEFT JOIN mass ON mass.v = t.v LEFT JOIN p1 ON p1.w = t.w
GROUP BY 1, 2
"""
