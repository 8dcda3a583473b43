"""Benchmark decontamination: hits of benchmark word windows in documents, native Spark only.

Words are maximal runs outside the separators after lower-casing A-Z.  Every
window of ``size`` consecutive item words (an item of fewer words is one window)
is anchored at its longest word.  The anchors form the broadcast hash set the
document words are probed against while they stream out of the scan; at a hit the
whole window is compared in place, so only verified occurrences ever leave the
task and a common anchor word costs no shuffle.  Beyond ``MAX_BROADCAST_ROWS``
windows the same join runs by shuffle on the anchor.

Defined results: a null or wordless text has no words, no hits and is clean; items
without words have no windows; repeated items count under each of their ids;
documents repeating an id are judged by their own text; null ids are kept.  Empty
tables give empty results or no hits.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.llm.common import plain, saved, small_side, table

SIZE = 13
# Separators of words in a text not yet lower-cased: A-Z belong to words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _split(text: Column) -> Column:
    """Words of a text in their own case; the first and last may be empty."""
    return F.split(F.coalesce(text, F.lit("")), SEPARATORS)


def _n_words(text: Column) -> Column:
    """Words of a text; the lambda binds the split, which is the costly part, once."""

    def count(words):
        first, last = F.get(words, F.lit(0)) == "", F.get(words, F.size(words) - 1) == ""
        return F.size(words) - F.when(F.size(words) == 1, first.cast("int")).otherwise(
            first.cast("int") + last.cast("int"))

    return F.get(F.transform(F.array(_split(text)), count), F.lit(0)).cast("long")


def _fold(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, UPPER, LOWER))


def windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct windows: joined words, n, offset and word of the anchor, ids of their items."""
    words = items.select(F.col(id_col).cast("string").alias("item"),
                         F.filter(_fold(_split(F.col(text_col))), lambda w: w != "").alias("w")
                         ).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    each = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("window"))
    longest = F.array_max(F.transform("window", lambda w, i: F.struct(F.length(w).alias("n"), (-i).alias("at"))))
    return (each.groupBy("window").agg(F.collect_set("item").alias("items"))
            .withColumn("at", -longest["at"])
            .select(F.array_join("window", " ").alias("window"), "items", F.size("window").alias("n"),
                    "at", F.lower(F.get("window", F.col("at"))).alias("anchor")))


def hits(docs: DataFrame, wins: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document with hits: its id, the text's hash, covered word spans and item ids."""
    words = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"),
                        _split(F.col(text_col)).alias("w"))
    # Every expression from here to the verified hit compiles into one stage (a lambda would
    # not), so the word array is referred to, not copied, for each word.
    spots = words.select("id", "h", "w", F.posexplode_outer("w").alias("p", "word"))
    start = F.col("p") - F.col("at")  # 0-based; the anchor is word p
    passage = F.array_join(F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("n")), " ")
    found = spots.join(
        small_side(wins),
        (F.lower("word") == F.col("anchor")) & (start >= 0)
        & (F.translate(passage, UPPER, LOWER) == F.col("window")))
    found = found.select("id", "h", start.alias("s"), (start + F.col("n")).alias("e"), "items")
    per_doc = found.groupBy("id", "h").agg(
        F.collect_set(F.struct("s", "e")).alias("spans"), F.collect_set("items").alias("items"))
    return per_doc.select("id", "h", F.array_sort("spans").alias("spans"),
                          F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(spans, zero, lambda a, x: F.struct(
        (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["end"]), F.lit(0))).alias("n"),
        F.greatest(a["end"], x["e"]).alias("end")))["n"].cast("long")


def find(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
         item_id: str = "item_id", item_text: str = "text", size: int = SIZE) -> DataFrame:
    """Per document: id, h (hash of the text), n_words, n_hit, items, spans, contaminated."""
    docs, items = plain(docs, doc_id, doc_text), plain(items, item_id, item_text)
    wins = saved(windows(items, item_id, item_text, size), "benchmark-windows")
    hit = hits(docs, wins, doc_id, doc_text).withColumnsRenamed({"id": "hid", "h": "hh"})
    each = docs.select(F.col(doc_id).alias("id"), F.xxhash64(doc_text).alias("h"),
                       _n_words(F.col(doc_text)).alias("n_words"))
    out = each.join(hit, F.col("id").eqNullSafe(F.col("hid")) & (F.col("h") == F.col("hh")), "left")
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0).cast("long"))
    return (out.select("id", "h", "n_words", n_hit.alias("n_hit"), "spans",
                       F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


# Words are numbered per text and joined back by ' ' so that a window is one string.
ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
         FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i
               FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
spots AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, i, s.n FROM spots s JOIN wins USING (n, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def remove_spans(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id",
                 doc_text: str = "text") -> DataFrame:
    """``docs`` with the words of every found span taken out of their texts.

    Where nothing was found the text stays as it is, byte for byte; elsewhere the
    remaining words are joined by one space.
    """
    spans = found.filter("n_hit > 0").select(F.col("id").alias("_id"), F.col("h").alias("_h"),
                                             F.col("spans").alias("_spans"))
    out = docs.join(spans, docs[doc_id].eqNullSafe(spans["_id"])
                    & (F.xxhash64(docs[doc_text]) == spans["_h"]), "left")
    left = F.filter(_split(docs[doc_text]), lambda w, i: (w != "") & ~F.exists(
        spans["_spans"], lambda x: (i >= x["s"]) & (i < x["e"])))
    text = F.when(spans["_spans"].isNull(), docs[doc_text]).otherwise(F.array_join(left, " "))
    return out.select(*[text.alias(c) if c == doc_text else docs[c] for c in docs.columns])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go."""
    found = find(docs, table(spark, sf_dir, "benchmark")).filter("contaminated")
    bad = found.select(F.col("id").alias("_id"), F.col("h").alias("_h")).distinct()
    bad = small_side(saved(bad, "contaminated"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"])
                     & (F.xxhash64(docs["text"]) == bad["_h"]), "left_anti")
