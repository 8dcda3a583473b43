"""Line dedup: an exact set-similarity join of lines; later matches are removed.

A line's set is its distinct words; two lines match when their sets' Jaccard
similarity is at least 0.8.  Lines are ordered by (document, number), documents by
their id and then their text's hash; a line goes when any earlier line matches it,
whether or not that one stays.

1. Lines with equal sets are one class, named by its first line.  Every line but the
   first of a class goes at once; only classes join.
2. A class's words are ordered by rarity (counts in a table of fixed size; any total
   order is exact), and its prefix of n - ceil(0.8 n) + 1 words is kept.
3. Where many classes have a part of their 256 parity bits in common, as near copies
   have where no word of theirs differs, they meet a few early ones of them first, so a
   group of near copies costs its size times a constant.  Whoever matches an earlier
   class there needs no other one.
4. The prefixes are posted.  Classes that share a prefix word are candidates if their lengths, the words from
   the shared one on and 128 parity bits of both sets allow enough common words.  No
   common word comes before the first shared one, so two matching classes pass there;
   meetings at later words need not.  The filters run inside the join, so only what
   passes leaves the task, and the skew join splits a word that many prefixes share.
   The postings carry half of a class's 256 bits; all are compared for the pairs left.
   Two classes that both match an earlier one already do not meet.
5. Candidates are verified on their whole sets, and a class with an earlier match
   goes.

Defined results: white space around words does not count; lines without words are
kept and match nothing; a null text stays null; rows repeating an id, or without one,
are documents of their own where their texts differ, and one document, treated alike,
where both are the same; null ids come first; an empty table gives an empty result; extra columns pass through ``dedup``; lines of any length are compared
whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.llm import wordhash as H
from tarmac.llm.common import map_arrow, plain, saved, small_side, table
from tarmac.llm.sketch import cell, counted

NUM, DEN = 80, 100     # lines match at DEN * intersection >= NUM * union
BITS = ["b0", "b1", "b2", "b3"]  # parities of a set's words in 256 cells
SLICE = 32             # bits that near copies have in common where no word differs; groups are found by them
LEAST = 6              # of these are set in a slice that tells a set from others
DENSE = 16             # classes that make a group
LEADERS = 4            # early classes of a group that its others meet first


def line_offsets(data: np.ndarray, offsets: np.ndarray):
    """Byte offsets of all lines of some texts, and the first line of every text."""
    ends = np.flatnonzero(data == 10) + 1
    bounds = np.union1d(ends, offsets)
    # a text that ends with a line end has no further line; an empty text has none
    return bounds, np.searchsorted(bounds, offsets)


def _words(texts: pa.Array):
    for _, data, offsets in H.pieces(texts):
        starts, ends, _ = H.bounds(data, offsets)
        yield H.words(data, starts, ends)


def _ordered(tokens: np.ndarray, line: np.ndarray, rank: np.ndarray):
    """Order of the tokens by line, rank (under 2 ** 13) and hash."""
    if not len(line) or int(line[-1]) < 1 << 20:
        key = (line.astype(np.uint64) << np.uint64(44)) | (rank << np.uint64(31)) | (tokens >> np.uint64(33))
        order = np.argsort(key)
        k, t = key[order], tokens[order]
        if not ((k[1:] == k[:-1]) & (t[1:] != t[:-1])).any():
            return order
    return np.lexsort((tokens, rank, line))  # two words with one short key: compare all bits


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rarity of every cell, in steps of a 128th of a doubling; worked out once, so all tasks order alike."""
    return (np.log2(np.maximum(counts, 1)) * 128).astype(np.uint16)


def line_sets(texts: pa.Array, rare: np.ndarray):
    """Per piece: (first row, line number in its text, row, sets by rarity, their bounds, digests, bits)."""
    for row, data, offsets in H.pieces(texts):
        bounds, first = line_offsets(data, offsets)
        starts, ends, at = H.bounds(data, bounds)
        tokens, line = H.words(data, starts, ends), H.rows_of(at)
        rank = rare[cell(tokens)].astype(np.uint64)
        order = _ordered(tokens, line, rank)
        tokens, line = tokens[order], line[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (line[1:] != line[:-1])
        tokens, line = tokens[new], line[new]
        n = len(bounds) - 1
        edge = np.searchsorted(line, np.arange(n + 1))
        d1, d2, *bits = (np.zeros(n, np.uint64) for _ in range(2 + len(BITS)))
        full = np.flatnonzero(np.diff(edge))
        if len(full):
            with np.errstate(over="ignore"):
                d1[full] = np.add.reduceat(tokens, edge[full])
                d2[full] = np.add.reduceat(H.mix(tokens + np.uint64(1)), edge[full])
                one = np.uint64(1) << (tokens >> np.uint64(58))
                part = (tokens >> np.uint64(56)) & np.uint64(len(BITS) - 1)
                for i, b in enumerate(bits):
                    b[full] = np.bitwise_xor.reduceat(np.where(part == i, one, np.uint64(0)), edge[full])
        text = np.searchsorted(first, np.arange(n), "right") - 1
        yield row, np.arange(n) - first[text], text, tokens, edge, d1, d2, bits


def _rows(whole: bool, rare):
    """Arrow rows of lines; lists hold whole sets, or the prefix where a set is new to the batch."""

    def run(batches):
        for batch in batches:
            ids, h = batch.column(0), batch.column(2)
            for row, number, text, tokens, edge, d1, d2, bits in line_sets(batch.column(1), rare.value):
                size = np.diff(edge)
                keep = size.copy()
                if not whole:
                    keep = np.where(size > 0, size - (NUM * size + DEN - 1) // DEN + 1, 0)
                    _, once = np.unique(d1, return_index=True)
                    again = np.ones(len(size), bool)
                    again[once] = False
                    keep[again] = 0
                inside = np.arange(len(tokens)) - np.repeat(edge[:-1], size) < np.repeat(keep, size)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(keep)), pa.int32()),
                                                 pa.array(tokens[inside].view(np.int64)))
                at = pa.array(row + text)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), h.take(at), pa.array(number, pa.int32()), pa.array(size, pa.int32()),
                     *[pa.array(x.view(np.int64)) for x in (d1, d2, *bits)], lists],
                    ["id", "h", "line", "n", "d1", "d2", *BITS, "words"])

    return run


KIND = "id {}, h long, line int, n int, d1 long, d2 long, b0 long, b1 long, b2 long, b3 long, words array<long>"


def _enough(common, nx, ny):
    return (NUM + DEN) * common >= NUM * (nx + ny)


def _apart(x: str, y: str, bits: list[str]):
    """Bits that differ: |X| + |Y| - 2 common >= these."""
    return sum(F.bit_count(F.col(x + b).bitwiseXOR(F.col(y + b))) for b in bits)


def _near(x: str, y: str, bits: list[str]):
    """Whether the lengths and parity bits of both sides allow a match."""
    n = F.col(f"{x}n") + F.col(f"{y}n")
    return _enough((n - _apart(x, y, bits)) / 2, n, F.lit(0))


def leaders(classes: DataFrame) -> DataFrame:
    """Candidate pairs (early, late) of classes in large groups: every one and its group's early classes."""
    parts = [F.shiftrightunsigned(b, at).bitwiseAND((1 << SLICE) - 1) for b in BITS for at in range(0, 64, SLICE)]
    parts = [F.when(F.bit_count(x) >= LEAST, x * len(parts) + i) for i, x in enumerate(parts)]
    key = F.explode(F.array(*parts)).alias("key")
    dense = saved(classes.select(key).filter("key IS NOT NULL").groupBy("key").count().filter(
        F.col("count") >= DENSE).select("key"), "line-dense")
    group = saved(classes.select("class", "first", "n", *BITS, key).join(small_side(dense), "key"), "line-groups")
    lead = saved(group.groupBy("key", F.pmod("class", F.lit(LEADERS))).agg(
        F.min(F.struct("first", "class", "n", *BITS)).alias("lead")).select(
        "key", *[F.col(f"lead.{c}").alias(f"l_{c}") for c in ("first", "class", "n", *BITS)]), "line-leaders")
    found = group.select("key", *[F.col(c).alias(f"c_{c}") for c in ("first", "class", "n", *BITS)]).join(
        small_side(lead), "key").filter((F.col("l_first") < F.col("c_first")) & _near("l_", "c_", BITS))
    return found.select(F.struct(F.col("l_first").alias("at"), F.col("l_class").alias("class")).alias("early"),
                        F.col("c_class").alias("late")).distinct()


def matches(classes: DataFrame, beaten: DataFrame) -> DataFrame:
    """Candidate pairs (x, y) of classes: shared prefix word, lengths, places and bits allow a match.

    ``beaten`` (late) are classes known to match an earlier one; two of them make no pair.
    """
    half = len(BITS) // 2
    bits = [F.col(a).bitwiseXOR(F.col(b)).alias(a) for a, b in zip(BITS, BITS[half:])]  # parities of wider cells
    known = small_side(beaten.select(F.col("late").alias("class"), F.lit(1).alias("known")))
    posted = classes.join(known, "class", "left").select(
        "class", F.col("n").cast("long").alias("n"), F.coalesce("known", F.lit(0)).alias("known"), *bits,
        F.posexplode("words").alias("pos", "word"))
    place = (F.col("n") * 2 + F.col("known")) * (1 << 31) + F.col("pos")
    # the shorter class of a match shares so much of itself that its first shared word stands early
    early = _enough(F.col("n") - F.col("pos"), F.col("n"), F.col("n"))

    def side(some: DataFrame, s: str) -> DataFrame:
        return some.select(F.col("word").alias(f"{s}_word"), F.col("class").alias(f"{s}_class"),
                           place.alias(f"{s}_place"), *[F.col(b).alias(f"{s}_{b}") for b in BITS[:half]])

    nx, ny = (F.shiftright(f"{s}_place", 32) for s in "xy")
    px, py = (F.col(f"{s}_place").bitwiseAND((1 << 31) - 1) for s in "xy")
    both = F.col("x_place").bitwiseAND(F.col("y_place")).bitwiseAND(1 << 31) != 0
    apart = _apart("x_", "y_", BITS[:half])
    # words differ at least where the bits do; from the first shared word on there are at
    # most as many common words as the shorter rest has
    near = ((nx < ny) | ((nx == ny) & (F.col("x_class") < F.col("y_class")))) & (DEN * nx >= NUM * ny) & ~both \
        & _enough(F.least(nx - px, ny - py), nx, ny) & _enough((nx + ny - apart) / 2, nx, ny)
    x = side(posted.filter(early), "x")
    met = [x.join(side(posted.filter(where), "y"), (F.col("x_word") == F.col("y_word")) & near).select(
        F.col("x_class").alias("x"), F.col("y_class").alias("y")) for where in (early, ~early)]
    return met[0].unionByName(met[1]).distinct()


def _true(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Later classes of the pairs (early, late) that match on their whole sets."""
    x, y = (sets.select(F.col("class").alias(s), F.col("words").alias(f"{s}_words")) for s in "xy")
    both = F.size(F.array_intersect("x_words", "y_words")).cast("long")
    size = F.size("x_words") + F.size("y_words")
    found = pairs.select(F.col("early.class").alias("x"), F.col("late").alias("y")).join(x, "x").join(y, "y")
    return found.filter(_enough(both, size, F.lit(0))).select(F.col("y").alias("late")).distinct()


def _later(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Classes (late) that match an earlier one of the candidate pairs (early, late)."""
    # most lines with a match already match their earliest candidate; only the others meet the rest
    lead = saved(pairs.groupBy("late").agg(F.min("early").alias("early")), f"{name}-leads")
    beaten = saved(_true(lead, sets), f"{name}-beaten")
    rest = pairs.join(beaten, "late", "left_anti").join(lead, ["late", "early"], "left_anti")
    return saved(beaten.unionByName(_true(rest, sets)).distinct(), f"{name}-later")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every line: id, h (hash of the text), line, n (distinct words), removed."""
    docs = plain(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    spark, kind = docs.sparkSession, KIND.format(docs.schema["id"].dataType.simpleString())
    rare = spark.sparkContext.broadcast(ranks(counted(docs.select("text"), _words)))  # of fixed size
    lines = saved(map_arrow(docs, _rows(False, rare), kind), "line-sets")
    first = F.min(F.struct("id", "h", "line")).alias("first")
    classes = saved(lines.filter("n > 0").groupBy("n", "d1", "d2").agg(
        first, F.count(F.lit(1)).alias("held"), F.max("words").alias("words"), *[F.first(b).alias(b) for b in BITS])
                    .withColumn("class", F.monotonically_increasing_id()), "line-classes")

    def whole(some: DataFrame, name: str) -> DataFrame:
        """(class, words) of the classes of ``some``: whole sets, from the texts that hold their first lines."""
        met = saved(classes.drop("held", "words", *BITS).join(some.distinct(), "class", "left_semi"), f"{name}-met")
        ids = met.select(F.col("first.id").alias("_id"), F.col("first.h").alias("_h")).distinct()
        ids = small_side(saved(ids, f"{name}-docs"))
        rows = docs.join(ids, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left_semi")
        sets = map_arrow(rows, _rows(True, rare), kind).select("n", "d1", "d2", "id", "h", "line", "words")
        return saved(sets.join(small_side(met), ["n", "d1", "d2"]).filter(
            F.struct("id", "h", "line").eqNullSafe(F.col("first"))).select(
            "class", "words").dropDuplicates(["class"]), f"{name}-whole")

    def named(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("early.class", "late")).alias("class"))

    pairs = saved(leaders(classes), "line-lead-pairs")
    beaten = _later(pairs, whole(named(pairs), "line-lead"), "line-lead")
    pairs = saved(matches(classes, beaten), "line-candidates")
    ends = saved(classes.drop("held", "words").join(
        pairs.select(F.explode(F.array("x", "y")).alias("class")).distinct(), "class", "left_semi"), "line-ends")
    x, y = (ends.select(F.col("class").alias(s), F.col("first").alias(f"{s}_first"), F.col("n").alias(f"{s}_n"),
                        *[F.col(b).alias(f"{s}_{b}") for b in BITS]) for s in "xy")
    pairs = pairs.join(x, "x").join(y, "y").filter(_near("x_", "y_", BITS))
    early = F.when(F.col("x_first") < F.col("y_first"), F.struct(F.col("x_first").alias("at"), F.col("x").alias("class")))
    early = early.otherwise(F.struct(F.col("y_first").alias("at"), F.col("y").alias("class")))
    late = F.when(F.col("x_first") < F.col("y_first"), F.col("y")).otherwise(F.col("x"))
    pairs = saved(pairs.select(early.alias("early"), late.alias("late")).join(
        small_side(beaten), "late", "left_anti"), "line-pairs")
    later = beaten.unionByName(_later(pairs, whole(named(pairs), "line"), "line"))
    later = saved(later.select(F.col("late").alias("class"), F.lit(True).alias("beaten")), "line-later-all")
    # a class of one line without an earlier match loses nothing, so its line need not meet it
    ruled = saved(classes.join(later, "class", "left").filter("held > 1 OR beaten")
                  .select("n", "d1", "d2", "first", F.coalesce("beaten", F.lit(False)).alias("beaten")), "line-ruled")
    out = lines.drop("words", *BITS).join(small_side(ruled), ["n", "d1", "d2"], "left")
    gone = F.col("beaten") | ~F.struct("id", "h", "line").eqNullSafe(F.col("first"))
    gone = F.when((F.col("n") > 0) & F.col("beaten").isNotNull(), gone)
    return out.select("id", "h", "line", "n", F.coalesce(gone, F.lit(False)).alias("removed"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the removed lines."""
    gone = removed_lines(docs, id_col, text_col).filter("removed").groupBy(
        F.col("id").alias("_id"), F.col("h").alias("_h")).agg(F.collect_set("line").alias("_gone"))
    parts = F.split(F.regexp_replace(docs[text_col], r"\n$", ""), "\n", -1)
    kept = F.filter(parts, lambda _, i: ~F.array_contains(gone["_gone"], i))
    out = docs.join(gone, docs[id_col].eqNullSafe(gone["_id"]) & (F.xxhash64(docs[text_col]) == gone["_h"]), "left")
    text = F.when(gone["_gone"].isNull(), docs[text_col]).otherwise(F.array_join(kept, "\n"))
    return out.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # a document written twice has each of its lines twice
    gone = F.sort_array(F.collect_set(F.when(F.col("removed"), F.col("line")))).alias("gone")
    found = removed_lines(docs).groupBy(F.col("id").alias("_id"), F.col("h").alias("_h")).agg(
        (F.max("line") + 1).cast("long").alias("n_lines"), gone)
    out = docs.select("doc_id", F.xxhash64("text").alias("h")).join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    return out.select(
        "doc_id", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
        F.size(F.coalesce("gone", F.array().cast("array<int>"))).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("removed_lines"))
