"""Phrase collocation mining: SON partitioning over chunks of text, then exact counts.

``chunked`` deals the texts into stored chunks of bounded size, one language each, cut
at piece ends where a text is longer.  A chunk belongs to one of ``SHARDS`` shards.

Mining (first pass): a chunk's distinct runs of one to three words become 64-bit keys
with counts, sorted, delta-coded and split by key range, so that a range's group holds
what all chunks know of its keys.  There every shard is mined completely at the
proportionally lowered support: a run that occurs ``support`` times in all occurs at
least ``ceil(support / SHARDS)`` times in some shard.  The shards' locally frequent keys are
united, and keys whose counts over all shards stay below the support leave.  Two runs with one
key only add up, so no frequent run is lost.

Counting (second pass): each range answers every chunk with one bit per key it sent,
the chunk counts the runs so marked by their words, not by their keys, and Spark adds
up (language, phrase).  No candidate list is broadcast or held in one place: a chunk
learns of its own runs only.

Scores are DataFrame arithmetic on decimals of 38 digits.

Defined results: a null text is empty, a null language ``und``; texts without words
give nothing; rows repeated count as often as they stand; ties end with the phrase's
bytes, so every rank is defined.  A piece without any end is one chunk, however
long.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tarmac.llm.common import map_arrow, plain, release, saved, table
from tarmac.session import ship_package

SUPPORT = 10
LONGEST = 3                 # words of the longest phrase
SHARDS = 4
COVER = 50                  # percent of a phrase's count at which a longer one replaces it
TOP = 2000
CHUNK_BYTES = 4 << 20
RANGE_KEYS = 2 << 20        # keys all chunks send to a range, on average
SALTS = 32                  # parts a language's first rows are picked in before the last pick

_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAPS = _ENDS.copy()
_GAPS[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


# ------------------------------------------------------------------ chunks

def _parts(text: bytes, limit: int) -> Iterator[bytes]:
    """The text, cut after a piece's end wherever it passes ``limit`` bytes."""
    while len(text) > limit:
        ends = np.flatnonzero(_ENDS[np.frombuffer(text, np.uint8, limit)])
        if not len(ends):
            ends = limit + np.flatnonzero(_ENDS[np.frombuffer(text, np.uint8, -1, limit)])[:1]
        if not len(ends):
            break
        yield text[:ends[-1] + 1]
        text = text[ends[-1] + 1:]
    yield text


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """One language's texts each, joined by a line end; unfinished chunks are bounded in sum."""
    open_: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    made = TaskContext.get().partitionId() << 32

    def closed(lang: str) -> pa.RecordBatch:
        nonlocal made
        made += 1
        size.pop(lang)
        body = b"\n".join(open_.pop(lang))
        return pa.RecordBatch.from_arrays(
            [pa.array([made - 1], pa.int64()), pa.array([lang], pa.string()), pa.array([_squeezed(body)], pa.binary()),
             pa.array([_count_words(body)], pa.int64())], ["chunk", "lang", "body", "n_words"])

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang = lang.as_py()
            for part in _parts(text.as_buffer().to_pybytes(), limit):
                if size.get(lang, 0) + len(part) > limit and lang in size:
                    yield closed(lang)
                open_.setdefault(lang, []).append(part)
                size[lang] = size.get(lang, 0) + len(part) + 1
            if sum(size.values()) > 4 * limit:
                yield closed(max(size, key=size.get))
    for lang in list(size):
        yield closed(lang)


def _squeezed(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _loosened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Stored (chunk, lang, body, n_words) of (lang, text); bodies are compressed.

    Row groups are a few chunks long, as a reader holds a whole one.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = map_arrow(rows, lambda batches: _chunks(batches, chunk_bytes),
                       "chunk long, lang string, body binary, n_words long")
    return saved(chunks, "phrases-chunks", **{"parquet.block.size": 2 * chunk_bytes})


# ------------------------------------------------------------------ runs of words

def _bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.concatenate([[False], ~_GAPS[raw], [False]])
    step = np.flatnonzero(inside[1:] != inside[:-1])
    return step[::2], step[1::2]


def _count_words(body: bytes) -> int:
    return len(_bounds(np.frombuffer(body, np.uint8))[0])


class Runs:
    """The runs of 1 to LONGEST words of a chunk, as numbers that stand for the words exactly."""

    def __init__(self, body: bytes):
        raw = np.frombuffer(_loosened(body), np.uint8)
        start, end = _bounds(raw)
        # what lies between the starts of two words is one piece's if no end is in it
        ends = np.concatenate([[0], np.cumsum(_ENDS[raw])])
        self.piece = ends[start]
        offsets = np.concatenate([[0], np.cumsum(end - start)])
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start),
            [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(_LOWER[raw[~_GAPS[raw]]].tobytes())])
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        self.word = coded.indices.to_numpy().astype(np.int64)

    def distinct(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(k, first word's place of each distinct run of k words, run number per place, its places)."""
        code, size = self.word, len(self.words)
        at = np.arange(len(code))
        for k in range(1, LONGEST + 1):
            if k > 1:
                # the run of k words at a place is the run of k - 1 words there and the word after it
                whole = at + k - 1 < len(self.word)
                at, code = at[whole], code[whole]
                whole = self.piece[at] == self.piece[at + k - 1]
                at, code = at[whole], code[whole]
                code = code * size + self.word[at + k - 1]
            _, first, code = np.unique(code, return_index=True, return_inverse=True)
            yield k, at[first], code, at

    def keys(self, lang: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(k, key per distinct run, first places, counts, -) of a language's runs."""
        seed = xxhash.xxh3_64_intdigest(lang)
        own = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.words.to_pylist()), np.uint64,
                          len(self.words))
        for k, first, code, _ in self.distinct():
            key = np.full(len(first), k, np.uint64)
            for i in range(k):
                key = _mixed(key * _MIX[0] ^ own[self.word[first + i]])
            yield k, key, first, np.bincount(code, minlength=len(first))

    def text(self, first: np.ndarray, k: int) -> pa.Array:
        words = [pc.cast(self.words.take(pa.array(self.word[first + i])), pa.string()) for i in range(k)]
        return words[0] if k == 1 else pc.binary_join_element_wise(*words, " ")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX[1]
    x = (x ^ (x >> np.uint64(29))) * _MIX[2]
    return x ^ (x >> np.uint64(32))


# ------------------------------------------------------------------ sorted keys of a range

def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte, with their counts held at 255."""
    steps = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    planes = np.concatenate([steps.T.reshape(-1), np.minimum(counts, 255).astype(np.uint8)])
    return len(keys).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 9 * n, codec="zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(planes[:8 * n].reshape(8, n).T).view(np.uint64)[:, 0]
    return np.cumsum(steps, dtype=np.uint64), planes[8 * n:]


def _sorted_keys(runs: Runs, lang: str):
    """All distinct runs of a chunk by key: keys, counts, first places, lengths."""
    found = list(runs.keys(lang))
    key, first, count = (np.concatenate([f[i] for f in found]) for i in (1, 2, 3))
    k = np.concatenate([np.full(len(f[1]), f[0], np.int8) for f in found])
    order = np.argsort(key, kind="stable")
    return key[order], count[order], first[order], k[order]


def _ranges(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(range, first, end) of those of ``n`` equal key ranges that sorted keys fall into; n < 2**31."""
    at = ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    first = np.flatnonzero(new)
    return at[first].astype(np.int32), first, np.append(first[1:], len(at))


def sent_keys(chunks: DataFrame, n: int) -> DataFrame:
    """(range, chunk, keys): what each chunk knows of each of ``n`` key ranges."""

    def send(batches):
        for batch in batches:
            for chunk, lang, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys, counts, _, _ = _sorted_keys(Runs(body), lang)
                some, first, end = _ranges(keys, n)
                packed = [_pack(keys[i:j], counts[i:j]) for i, j in zip(first, end)]
                release()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(np.full(len(some), chunk, np.int64)),
                     pa.array(packed, pa.binary())], ["range", "chunk", "keys"])

    return map_arrow(chunks.select("chunk", "lang", "body"), send, "range int, chunk long, keys binary")


def shard_of(chunk: np.ndarray | int, shards: int):
    """The shard of a chunk: its number mixed, so that neighbours fall apart."""
    return _mixed(np.asarray(chunk, np.uint64) + _MIX[0]) % np.uint64(shards)


def mined(keys: list[np.ndarray], counts: list[np.ndarray], shard: np.ndarray, support: int,
          shards: int) -> list[np.ndarray]:
    """For each chunk's keys, whether they are candidates."""
    key = np.concatenate(keys)
    count = np.concatenate(counts).astype(np.int64)
    owner = np.repeat(shard.astype(np.int64), [len(k) for k in keys])
    distinct, at = np.unique(key, return_inverse=True)
    least = -(-support // shards)
    frequent = np.zeros(len(distinct), bool)
    total = np.zeros(len(distinct), np.int64)
    for s in range(shards):
        here = owner == s
        local = np.bincount(at[here], count[here], len(distinct)).astype(np.int64)
        frequent |= local >= least
        total += local
    frequent &= total >= support
    return np.split(frequent[at], np.cumsum([len(k) for k in keys])[:-1])


def candidates(sent: DataFrame, support: int, shards: int) -> DataFrame:
    """(chunk, range, marks): one bit per key a chunk sent to a range, set for candidates."""
    ship_package(sent.sparkSession)

    def mine(group):
        unpacked = [_unpack(x.as_py()) for x in group["keys"]]
        chunk = group["chunk"].to_numpy()
        marks = mined([u[0] for u in unpacked], [u[1] for u in unpacked], shard_of(chunk, shards), support, shards)
        out = pa.table({"chunk": chunk, "range": group["range"],
                        "marks": pa.array([np.packbits(m).tobytes() for m in marks], pa.binary())})
        release()
        return out

    return sent.groupBy("range").applyInArrow(mine, "chunk long, range int, marks binary")


def counted(chunks: DataFrame, marks: DataFrame, n: int) -> DataFrame:
    """(lang, phrase, f) of all candidates, counted by their words."""
    ship_package(chunks.sparkSession)
    kind = "lang string, phrase string, f long"

    def count(own, told):
        out = []
        for lang, body in zip(own["lang"].to_pylist(), own["body"].to_pylist()):
            runs = Runs(body)
            keys, counts, first, k = _sorted_keys(runs, lang)
            place = {r: (i, j) for r, i, j in zip(*(x.tolist() for x in _ranges(keys, n)))}
            chosen = np.zeros(len(keys), bool)
            for at, bits in zip(told["range"].to_pylist(), told["marks"].to_pylist()):
                i, j = place[at]
                chosen[i:j] = np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i)
            for length in range(1, LONGEST + 1):
                these = np.flatnonzero(chosen & (k == length))
                phrase = runs.text(first[these], length)
                out.append(pa.table({"lang": pa.array([lang] * len(these), pa.string()), "phrase": phrase,
                                     "f": counts[these].astype(np.int64)}))
        release()
        return pa.concat_tables(out)

    per_chunk = chunks.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(count, kind)
    return per_chunk.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, shards: int = SHARDS,
                     chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Stored (lang, phrase, f) of all runs of 1 to LONGEST words with f >= support, and (lang, n)."""
    chunks = chunked(docs, chunk_bytes)
    words = chunks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    total = chunks.agg(F.sum("n_words")).first()[0] or 0
    n = max(1, -(-LONGEST * total // RANGE_KEYS))
    chunks = chunks.filter("n_words > 0")
    marks = saved(candidates(sent_keys(chunks, n), support, shards), "phrases-marks")
    found = saved(counted(chunks, marks, n).filter(F.col("f") >= support), "phrases-frequent")
    return found, words


# ------------------------------------------------------------------ scores

def _words(phrase: Column) -> Column:
    return F.size(F.split(phrase, " "))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", support: int = SUPPORT,
                 cover: int = COVER, top: int = TOP, shards: int = SHARDS,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases."""
    if support < 1:
        raise ValueError(f"support must be at least 1, got {support}")
    docs = plain(docs, lang_col, text_col)
    docs = docs.select(docs[lang_col].alias("lang"), docs[text_col].alias("text"))
    found, words = frequent_phrases(docs, support, shards, chunk_bytes)
    parts = found.select("lang", "phrase", "f")
    phrases = parts.withColumn("words", F.split("phrase", " ")).filter(F.size("words") > 1)
    join = lambda *c: F.array_join(F.slice("words", *c), " ")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k", join(F.lit(1), F.col("k")).alias("first"),
        join(F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"))
    of = lambda side, name: parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    cuts = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    cuts = cuts.withColumns({"up": F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")),
                             "down": wide("l") * wide("r")}).withColumn("score", F.expr("up div down"))
    scored = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.min("a").alias("a"))
    # the largest count of a longer phrase around each of its shorter runs
    inner = phrases.filter(F.size("words") > 2).select("lang", "f", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("words") - 1), lambda size: F.transform(
            F.sequence(F.lit(1), F.size("words") - size + 1),
            lambda at: F.array_join(F.slice("words", at, size), " "))))).alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("longer") < F.col("a") * F.lit(cover)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                       F.col("cut.score").alias("score"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    # a language's first rows in each of its parts, then among those: no task holds a whole language
    part = Window.partitionBy("lang", "salt").orderBy(*order)
    rows = rows.withColumn("at", F.row_number().over(part)).filter(F.col("at") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(whole).cast("long")).filter(F.col("rank") <= top)
    return rows.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = """
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
run AS (SELECT lang, list_filter(regexp_split_to_array(p, '[ \\t]+'), lambda x: x <> '') AS w FROM piece),
word AS (SELECT lang, unnest(w) AS phrase, 1 AS k FROM run),
two AS (SELECT lang, w[i] || ' ' || w[i + 1] AS phrase, 2 AS k
        FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM run)),
three AS (SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS phrase, 3 AS k
          FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM run)),
f AS (SELECT lang, phrase, k, count(*) AS f FROM (FROM word UNION ALL FROM two UNION ALL FROM three)
      GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, count(*) AS n FROM word GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT c.lang, c.phrase, c.k, a, i, l.f AS l, r.f AS r,
               CAST(1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f) AS BIGINT) AS score
        FROM (SELECT *, unnest(range(1, k)) AS i FROM c) c
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:i], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[i + 1:c.k], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
longer AS (SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM c WHERE k = 3
    UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM c WHERE k = 3) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank,
       b.phrase, b.a, b.l, b.r, n.n, b.score
FROM best b JOIN n ON n.lang = b.lang LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
WHERE g.a IS NULL OR 100 * g.a < 50 * b.a
QUALIFY rank <= 2000
"""
