"""N-gram Jaccard join: an exact self-join of shingle sets in the Jaccard metric space.

d = 1 - Jaccard is a metric on sets, and documents link at d <= 0.2.

1. Documents with one and the same set fall into one class; from here on a class
   is one point.
2. Level 0 pivots are the one-shingle sets, rare ones first (a fixed-size count
   table estimates rarity; any total order is exact).  A point at distance 0.2 of
   another shares all but a fifth of its shingles, so replicating each point into
   the regions of its first n - ceil(0.8 n) + 1 shingles brings every linked pair
   together in a region.
3. In a region documents are the pivots.  The region's pivot is compared with every
   member that sizes and places allow, and links join components.  A region whose
   members are one component is done: no further pair can change the result, so a
   large group of near copies costs one comparison per member.  This is done
   ``STARS`` times with other pivots.
4. What is left joins recursively: a region of at most ``SMALL`` members compares
   the pairs of different components that the triangle inequality allows
   (|d(x,p) - d(y,p)| <= 0.2) and whose parity bits allow a link.  A larger one takes ``PIVOTS`` members as pivots,
   every member goes to its nearest pivot's Voronoi region and is replicated into
   each region with d(x,q) <= d(x,home) + 0.4, and these regions follow in the next
   round.  A region that does not shrink compares its pairs by size order.

Every comparison intersects whole sets of 64-bit shingle hashes.

Defined results: a null, empty or wordless text has no shingles, is its own
component and links with nothing; a text of fewer than five words is one shingle;
rows repeating an id are linked when their sets are; ids may be null and then lose
as component id; an empty table gives an empty result; extra columns are ignored.
``stage`` judges every row by its id and its text: other rows of the id stay, as do
rows that tie on the least id of their component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tarmac.llm import wordhash as H
from tarmac.llm.common import map_arrow, plain, saved, small_side, table
from tarmac.llm.components import components
from tarmac.llm.sketch import cell, counted

WORDS = 5
NUM, DEN = 80, 100          # links at DEN * intersection >= NUM * union
SMALL = 4096                # members of a region that is compared pair by pair
PIVOTS = 16                 # document pivots of a larger region
EPS = 1 - NUM / DEN
LONG = 512                  # shingles of a set whose parities get more bits than WIDE
STARS = 2                   # rounds of one pivot per region
WIDE = [f"w{k}" for k in range(16)]   # parity of the hashes on each of 1024 bits


def shingle_sets(texts: pa.Array, words: int = WORDS):
    """Per piece of a column: (first row, hashes sorted within rows, their rows, bounds)."""
    for row, data, offsets in H.pieces(texts):
        starts, ends, first = H.bounds(data, offsets)
        tokens = H.words(data, starts, ends)
        grams = H.grams(tokens, words)
        inside = H.whole_grams(first, words, len(grams))
        rows = H.rows_of(first)
        count = np.diff(first)
        got, at = grams[inside], rows[:len(grams)][inside]
        for short in np.flatnonzero((count > 0) & (count < words)):
            whole = H.grams(tokens[first[short]:first[short + 1]], int(count[short]))
            # the length belongs to the shingle: no sequence equals a part of another
            got, at = np.append(got, H.mix(whole + np.uint64(count[short]))), np.append(at, short)
        order = np.lexsort((got, at))
        got, at = got[order], at[order]
        new = np.ones(len(got), bool)
        new[1:] = (got[1:] != got[:-1]) | (at[1:] != at[:-1])
        got, at = got[new], at[new]
        yield row, got, at, np.searchsorted(at, np.arange(len(count) + 1))


def _prints(docs: DataFrame, words: int, whole: bool, sketch) -> DataFrame:
    """Per document: id, h, n, two digests of its set, and the set (``whole``) or its prefix by rarity."""

    def each(batches):
        rare = sketch.value if sketch is not None else None
        for batch in batches:
            ids, texts, h = batch.column(0), batch.column(1), batch.column(2)
            for row, got, at, edge in shingle_sets(texts, words):
                size = np.diff(edge)
                d1, d2 = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
                full = np.flatnonzero(size)
                if len(full):
                    with np.errstate(over="ignore"):
                        d1[full] = np.add.reduceat(got, edge[full])
                        d2[full] = np.add.reduceat(H.mix(got + np.uint64(1)), edge[full])
                keep, bound = got, edge
                if not whole:
                    seen = rare[cell(got)]
                    order = np.lexsort((got, seen, at))
                    prefix = size - (NUM * size + DEN - 1) // DEN + 1
                    prefix[size == 0] = 0
                    inside = np.arange(len(got)) - edge[:-1][at] < prefix[at]
                    keep = got[order][inside]
                    bound = np.concatenate([[0], np.cumsum(prefix)])
                lists = pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(keep.view(np.int64)))
                bits = np.zeros((len(WIDE), len(size)), np.uint64)
                if not whole:
                    # one bit per hash: texts x words x bits as one histogram, then its parity
                    bit = (at * 1024 + (got >> np.uint64(54)).astype(np.int64))
                    odd = np.bincount(bit, minlength=len(size) * 1024).reshape(len(size), 1024) & 1
                    bits = np.packbits(odd.astype(np.uint8), axis=1).view(np.uint64).T
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(size)), h.slice(row, len(size)), pa.array(size, pa.int64()),
                     *[pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (d1, d2, *bits)], lists],
                    ["id", "h", "n", "d1", "d2", *WIDE, "hashes"])

    kind = docs.schema["id"].dataType.simpleString()
    return map_arrow(docs.select("id", "text", "h"), each,
                     f"id {kind}, h long, n long, d1 long, d2 long, {', '.join(f'{b} long' for b in WIDE)}, hashes array<long>")


def _bit_length(n):
    """Bits of a long set's parities: four a shingle at least, in powers of two."""
    return 1 << int(np.ceil(np.log2(4 * n)))


def _parities(docs: DataFrame, words: int) -> DataFrame:
    """(n, d1, d2, bits) of the documents with sets over ``LONG``."""

    def each(batches):
        for batch in batches:
            for _, got, at, edge in shingle_sets(batch.column(0), words):
                for k in np.flatnonzero(np.diff(edge) > LONG):
                    s = got[edge[k]:edge[k + 1]]
                    size = _bit_length(len(s))
                    place = (s >> np.uint64(64 - int(size).bit_length() + 1)).astype(np.int64)
                    odd = (np.bincount(place, minlength=size) & 1).astype(np.uint8)
                    with np.errstate(over="ignore"):
                        d1, d2 = s.sum(dtype=np.uint64), H.mix(s + np.uint64(1)).sum(dtype=np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(s)], pa.int64()), *[pa.array(np.array([d]).view(np.int64)) for d in (d1, d2)],
                         pa.array([np.packbits(odd).view(np.int64)], pa.list_(pa.int64()))], ["n", "d1", "d2", "bits"])

    return map_arrow(docs.select("text"), each, "n long, d1 long, d2 long, bits array<long>")


def _close(nx, ny):
    """Sizes that allow a link."""
    return DEN * F.least(nx, ny) >= NUM * F.greatest(nx, ny)


def _reach(nx, ny, px, py):
    """Places px, py of a shared shingle that allow a link: what can still be shared suffices."""
    most = F.least(px, py) + F.least(nx - px, ny - py)
    return (NUM + DEN) * most >= NUM * (nx + ny)


def _bits_allow(x: str, y: str, nx, ny):
    """Sets differ in at least as many shingles as their parities do in bits."""
    apart = sum(F.bit_count(F.col(f"{x}{b}").bitwiseXOR(F.col(f"{y}{b}"))) for b in WIDE)
    return (NUM + DEN) * (nx + ny - apart) >= 2 * NUM * (nx + ny)


class Sets:
    """Whole shingle sets of nodes, worked out anew from the texts of those a round asks for.

    ``nodes``: node, first_id and first_h (a document that holds the set), n, d1, d2 and WIDE.
    """

    def __init__(self, docs: DataFrame, nodes: DataFrame, words: int):
        self.docs, self.nodes, self.words = docs, nodes, words

    def _rows(self, ends: DataFrame) -> DataFrame:
        """The documents that hold the sets of ``ends``; ids alone may be null or repeat."""
        firsts = ends.select(F.col("first_id").alias("_id"), F.col("first_h").alias("_h"))
        return self.docs.join(firsts, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left_semi")

    def _long_allowed(self, pairs: DataFrame, name: str) -> DataFrame:
        """``pairs`` without those of long sets that parities in proportion to the sets rule out."""
        ends = pairs.select("pair", F.explode(F.array("a", "b")).alias("node")).join(
            self.nodes.filter(F.col("n") > LONG).select("node", "first_id", "first_h", "n", "d1", "d2"), "node")
        ends = saved(ends, f"{name}-long")
        bits = _parities(self._rows(small_side(ends)), self.words).join(small_side(ends), ["n", "d1", "d2"]).groupBy("pair").agg(
            F.collect_set(F.struct("bits", "n")).alias("s"))
        x, y = F.get("s", F.lit(0)), F.get("s", F.lit(1))
        size = x["n"] + y["n"]
        apart = F.aggregate(F.zip_with(x["bits"], y["bits"], lambda a, b: F.bit_count(a.bitwiseXOR(b))),
                            F.lit(0), lambda a, b: a + b)
        far = bits.filter((F.size(x["bits"]) == F.size(y["bits"])) & (
            (NUM + DEN) * (size - apart) < 2 * NUM * size)).select("pair")
        return pairs.join(far, "pair", "left_anti")

    def verified(self, pairs: DataFrame, name: str, all_distances: bool = False) -> DataFrame:
        """(a, b, d, linked) of distinct pairs (a, b), by intersecting whole sets.

        Pairs that their parities rule out are left out unless ``all_distances``.
        """
        if not all_distances:
            x, y = (self.nodes.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("n", *WIDE)])
                    for s in "ab")
            pairs = pairs.join(x, "a").join(y, "b").filter(
                _bits_allow("a_", "b_", F.col("a_n"), F.col("b_n"))).select("a", "b")
        pairs = saved(pairs.withColumn("pair", F.monotonically_increasing_id()), f"{name}-pairs")
        if not all_distances:
            pairs = saved(self._long_allowed(pairs, name), f"{name}-left")
        ends = pairs.select("pair", F.explode(F.array("a", "b")).alias("node")).join(
            self.nodes.select("node", "first_id", "first_h", "n", "d1", "d2"), "node")
        ends = small_side(saved(ends, f"{name}-ends"))
        # each set travels once per pair it is in, to the task of that pair
        sets = _prints(self._rows(ends), self.words, True, None).select("n", "d1", "d2", "hashes").join(ends, ["n", "d1", "d2"])
        both = sets.groupBy("pair").agg(F.collect_set("hashes").alias("s"))
        x, y = F.get("s", F.lit(0)), F.get("s", F.lit(1))
        shared = F.size(F.array_intersect(x, y)).cast("long")
        both = both.select("pair", shared.alias("i"), (F.size(x) + F.size(y) - shared).alias("u"))
        return saved(pairs.join(both, "pair").select("a", "b", (1 - F.col("i") / F.col("u")).alias("d"),
                                                     (DEN * F.col("i") >= NUM * F.col("u")).alias("linked")), name)


def _pairs(x, y):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _merge(comp: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Components (node, root) after ``links`` (a, b); a node that is missing is its own root."""
    if comp is None:
        return saved(components(links, name), f"{name}-roots")
    root = comp.withColumnsRenamed({"node": "_n", "root": "_r"})
    for side in ("a", "b"):
        links = links.join(root, F.col(side) == F.col("_n"), "left").withColumn(
            side, F.coalesce("_r", side)).drop("_n", "_r")
    over = saved(components(links, name), f"{name}-over").withColumnsRenamed({"node": "_n", "root": "_r"})
    moved = comp.join(over, F.col("root") == F.col("_n"), "left").select(
        "node", F.coalesce("_r", "root").alias("root"))
    new = over.join(comp, F.col("_n") == F.col("node"), "left_anti").select(
        F.col("_n").alias("node"), F.col("_r").alias("root"))
    return saved(moved.unionByName(new), f"{name}-roots")


def _rooted(members: DataFrame, comp: DataFrame) -> DataFrame:
    """``members`` of unresolved regions only, with their ``root``."""
    with_root = members.join(small_side(comp), "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = with_root.groupBy("region").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                            F.count(F.lit(1)).alias("members")).filter("lo <> hi")
    return with_root.join(open_.select("region", "members"), "region")


def class_components(cells: DataFrame, sets: Sets, bits: DataFrame, small: int = SMALL,
                     pivots: int = PIVOTS, stars: int = STARS) -> DataFrame:
    """(node, root) of the nodes with links.  ``cells``: region, node, n, pos; ``bits``: node and WIDE."""
    rest = cells.select("region", "node", "n", "pos", F.lit(None).cast("double").alias("d"), F.lit(True).alias("core"))
    comp = None
    for n in range(stars):
        if n > 1:
            rest = saved(_rooted(rest, comp), f"jaccard-rest{n}")
        if n and rest.isEmpty():
            return comp
        # rare shingles of its own push a member's common ones back: the least place tells the original
        # of a group of copies.  Later rounds take some other component's member.
        turn = F.lit(0) if n == 0 else F.xxhash64("root", F.lit(n))
        lead = F.min(F.struct(turn.alias("turn"), "pos", F.xxhash64("node").alias("tie"), "node", "n",
                              *(WIDE if n else []), *(["root"] if n else []))).over(W.partitionBy("region"))
        star = rest.withColumn("p", lead)
        near = F.col("node") != F.col("p.node")
        near &= _close(F.col("n"), F.col("p.n")) & _reach(F.col("n"), F.col("p.n"), F.col("pos"), F.col("p.pos"))
        if n:
            near &= (F.col("root") != F.col("p.root")) & _bits_allow("", "p.", F.col("n"), F.col("p.n"))
        pairs = star.filter(near).select(*_pairs("node", "p.node")).distinct()
        known = sets.verified(pairs, f"jaccard-star{n}")
        comp = _merge(comp, known.filter("linked").select("a", "b"), f"jaccard-comp{n}")
        if n == 0:
            span = known.select("a", "b", "d")
            span = span.unionByName(span.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
            star = star.select("region", "node", "n", "pos", "core", F.col("p.node").alias("pivot"))
            to = F.when(F.col("node") == F.col("pivot"), F.lit(0.0)).otherwise(F.col("d"))
            rest = star.join(small_side(span.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "d")),
                             ["node", "pivot"], "left").withColumn("d", to).select(
                "region", "node", "n", "pos", "d", "core")
            rest = saved(_rooted(rest, comp).join(bits, "node"), "jaccard-rest1")
        else:
            rest = rest.drop("root", "members")
    for n in range(1, 64):
        rest = saved(_rooted(rest.drop("root", "members"), comp), f"jaccard-open{n}")
        if rest.isEmpty():
            return comp
        pairs = _within(rest.filter(F.col("members") <= small))
        large = rest.filter(F.col("members") > small)
        again = None
        if not large.isEmpty():
            turn = F.row_number().over(W.partitionBy("region").orderBy(F.xxhash64("node", F.lit(n)), "node"))
            heads = large.filter("core").withColumn("turn", turn).filter(F.col("turn") <= pivots)
            heads = heads.select("region", F.col("node").alias("head"))
            spokes = saved(large.join(heads, "region"), f"jaccard-spokes{n}")
            far = sets.verified(spokes.filter("node <> head").select(*_pairs("node", "head")).distinct(),
                                f"jaccard-spans{n}", all_distances=True)
            comp = _merge(comp, far.filter("linked").select("a", "b"), f"jaccard-far{n}")
            ends = [F.col("a").alias("node"), F.col("b").alias("head")]
            back = [F.col("b").alias("node"), F.col("a").alias("head")]
            span = far.select(*ends, F.col("d").alias("to")).unionByName(far.select(*back, F.col("d").alias("to")))
            at = spokes.join(span, ["node", "head"], "left").withColumn(
                "to", F.when(F.col("node") == F.col("head"), F.lit(0.0)).otherwise(F.col("to")))
            home = F.min(F.struct("to", "head")).over(W.partitionBy("region", "node"))
            at = at.withColumn("home", home).filter(F.col("to") <= F.col("home.to") + 2 * EPS + 1e-9)
            again = saved(at.select("region", F.xxhash64("region", "head").alias("inner"), "node", "n", "pos",
                                    F.col("to").alias("d"), (F.col("head") == F.col("home.head")).alias("core"),
                                    "members", *WIDE), f"jaccard-voronoi{n}")
            # a region that hardly shrinks is compared by size order, the rest goes on
            sizes = again.groupBy("region", "inner").agg(F.count(F.lit(1)).alias("now"), F.max("members").alias("was"))
            stuck = sizes.filter("now > 0.8 * was").select("region").distinct()
            pairs = pairs.unionByName(_within(large.join(stuck, "region", "left_semi")))
            again = again.join(stuck, "region", "left_anti").select(
                F.col("inner").alias("region"), "node", "n", "pos", "d", "core", *WIDE)
        got = sets.verified(pairs.distinct(), f"jaccard-round{n}")
        comp = _merge(comp, got.filter("linked").select("a", "b"), f"jaccard-comp{n}")
        if again is None:
            return comp
        rest = again
    raise RuntimeError("jaccard join: regions did not settle")


def _within(members: DataFrame) -> DataFrame:
    """Pairs of different components in a region that sizes, places, bits and the pivot's distance allow."""
    x, y = (members.select("region", *[F.col(c).alias(f"{side}_{c}") for c in (
        "node", "n", "pos", "d", "root", "core", *WIDE)]) for side in "xy")
    nx, ny = F.col("x_n"), F.col("y_n")
    near = F.expr("x_node < y_node AND x_root <> y_root AND (x_core OR y_core)") & _close(nx, ny) \
        & _reach(nx, ny, F.col("x_pos"), F.col("y_pos")) & _bits_allow("x_", "y_", nx, ny)
    window = F.coalesce(F.abs(F.col("x_d") - F.col("y_d")) <= EPS + 1e-9, F.lit(True))
    both = x.withColumnRenamed("region", "x_region").join(y, (F.col("x_region") == F.col("region")) & near & window)
    return both.select(F.col("x_node").alias("a"), F.col("y_node").alias("b"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Per document: id, h (hash of the text), n_shingles, component_id."""
    spark = docs.sparkSession
    docs = plain(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    seen = counted(docs.select("text"), lambda texts: (got for _, got, _, _ in shingle_sets(texts, words)))
    sketch = spark.sparkContext.broadcast(seen)  # of fixed size
    prints = saved(_prints(docs, words, False, sketch), "jaccard-prints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h"))  # a null id only if all are
    classes = saved(prints.filter("n > 0").groupBy("n", "d1", "d2").agg(
        first.alias("first"), F.first("hashes").alias("hashes"), *[F.first(b).alias(b) for b in WIDE])
        .withColumns({"node": F.monotonically_increasing_id(), "first_id": F.col("first.id"),
                      "first_h": F.col("first.h")}).drop("first"), "jaccard-classes")
    # size and place share a long: most of these rows meet nobody, so they are kept narrow
    posted = classes.select("node", "n", F.posexplode("hashes").alias("pos", "region")).select(
        "region", "node", (F.shiftleft("n", 31) + F.col("pos")).alias("place"))
    together = F.count(F.lit(1)).over(W.partitionBy("region"))
    cells = posted.withColumn("members", together).filter("members > 1").select(
        "region", "node", F.shiftright("place", 31).alias("n"),
        F.col("place").bitwiseAND((1 << 31) - 1).cast("int").alias("pos"))
    cells = saved(cells, "jaccard-cells")
    sets = Sets(docs, classes.drop("hashes"), words)
    comp = class_components(cells, sets, classes.select("node", *WIDE))
    roots = classes.select("node", "n", "d1", "d2", "first_id").join(comp, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    least = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = saved(roots.join(least, "root").select("n", "d1", "d2", "component_id"), "jaccard-named")
    return prints.select("id", "h", "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left").select(
        "id", "h", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).drop("h").withColumnRenamed("id", "doc_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the least doc_id stays."""
    gone = join(docs).filter(~F.col("id").eqNullSafe(F.col("component_id"))).select(
        F.col("id").alias("_id"), F.col("h").alias("_h"))
    gone = small_side(saved(gone.distinct(), "jaccard-gone"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"])
                     & (F.xxhash64(docs["text"]) == gone["_h"]), "left_anti")
