"""Sharding by balanced label propagation, native Spark only.

Every document starts in the shard of its id's hash.  In each round a link group
(documents that share a link key, here: equal texts) counts its members per shard
with one partial aggregate, and members elsewhere want to move to the shard that
holds most of the group.  The flows between shards form a small matrix; quotas cut
them so that no shard outgrows its capacity, and a group moves as one because the
quota is taken by a hash of its key.  Rounds go on until no flow is left or allowed,
or the rows apart from most of their group stay as many for ``STILL`` rounds; the
round with fewest counts, and their number is logged.  Then an exact settling step ranks
each shard's documents, linked ones first, keeps as many as the shard may hold and
moves the rest (documents without links before all others) into the free places.

Groups larger than a shard are first cut into blocks of at most ``BLOCK`` of a
shard, so a group holding a third of all rows spreads over the shards it needs and
no more.  Ranks come from a range sort over (key, id), which splits hot keys, plus
one offset per partition; nothing gathers a group in one task.

Law ``rows``: counts differ by at most one.  Slots are gapless from 0 per shard.

Defined results: a null text has size 8 and crc32 0 and is linked with the empty
ones; rows repeating an id are placed one by one; null ids are placed too; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tarmac.llm.common import plain, saved, table

SHARDS = 24
ROUNDS = 40       # safety bound only
STILL = 3         # rounds without fewer rows apart, after which none is expected
BLOCK = 0.25      # largest piece of a link group, as a share of a shard
GRAIN = 1 << 20   # grain of the hashed quota


def ranked(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` with ``rank``: the 0-based position in the order of ``keys`` over all rows.

    Range partitions are written with their row numbers; the counts per partition
    (one row each, so bounded by the number of partitions) become offsets.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = saved(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                 .withColumn("_at", F.monotonically_increasing_id()), name)
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (rows.groupBy(part.alias("_part")).agg((F.max(at) + 1).alias("rows"))
               .select("_part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_offset")))
    return (rows.join(F.broadcast(offsets), part == F.col("_part"))
            .withColumn("rank", F.col("_offset") + at).drop("_at", "_part", "_offset"))


def quotas(flows: dict, held: dict, shards: int, cap: float) -> list[int]:
    """Per flow (a, b), at a * shards + b: the share, in ``GRAIN``, that may move.

    No shard ends above ``cap``: what flows in fits into the room it has and what
    surely flows out, which is worked out in a few passes.
    """
    share = dict.fromkeys(flows, 0.0)
    for _ in range(8):
        out = {s: sum(w * share[a, b] for (a, b), w in flows.items() if a == s) for s in range(shards)}
        into = {s: sum(w for (a, b), w in flows.items() if b == s) for s in range(shards)}
        share = {(a, b): min(1.0, max(0.0, cap - held.get(b, 0) + out[b]) / into[b]) for a, b in flows}
    return [int(share.get((a, b), 0) * GRAIN) for a in range(shards) for b in range(shards)]


def propagate(nodes: DataFrame, shards: int, rounds: int = ROUNDS) -> tuple[DataFrame, int]:
    """Move the linked rows of ``nodes`` (id, key, linked, shard, ...) towards their links.

    Also gives the number of rows still apart from most of their group.
    Rows without links give way at no cost, so only linked rows count against the
    capacity here; ``settle`` evens out the rest.
    """
    cap = nodes.count() / shards
    closest, least, still = nodes, None, 0
    for n in range(rounds + 1):
        held = saved(nodes.filter("linked").groupBy("key", "shard").count(), f"shard-held-{n}")
        # the shard with most of the group wins, ties fall by hash
        best = held.groupBy("key").agg(
            F.max(F.struct("count", F.xxhash64("key", "shard").alias("tie"), "shard")).alias("most"),
            F.count(F.lit(1)).alias("spread")).filter("spread > 1")
        moves = held.join(best.select("key", F.col("most.shard").alias("target")), "key").filter("shard <> target")
        moves = saved(moves, f"shard-moves-{n}")
        # at most shards * shards rows
        flows = {(r["shard"], r["target"]): r["w"] for r in
                 moves.groupBy("shard", "target").agg(F.sum("count").alias("w")).collect()}
        apart = sum(flows.values())
        if least is None or apart < least:
            closest, least, still = nodes, apart, 0
        else:
            still += 1
        if not flows or still == STILL or n == rounds:
            break
        sizes = {r["shard"]: r["n"] for r in held.groupBy("shard").agg(F.sum("count").alias("n")).collect()}
        share = quotas(flows, sizes, shards, cap)
        if not any(share):
            break
        quota = F.get(F.lit(share), F.col("shard") * shards + F.col("target"))
        turn = F.pmod(F.xxhash64("key", F.lit(n)), F.lit(GRAIN))
        allowed = moves.filter(turn < quota).select("key", "shard", "target")
        nodes = saved(nodes.join(allowed, ["key", "shard"], "left")
                      .withColumn("shard", F.coalesce("target", "shard")).drop("target"), f"shard-labels-{n}")
    return closest, least


def settle(nodes: DataFrame, shards: int) -> DataFrame:
    """Exact even counts: adds ``slot`` and corrects ``shard`` of the rows over quota."""
    order = ranked(nodes.withColumn("free", ~F.col("linked")), ["shard", "free", "key", "id"], "shard-order")
    held = {r["shard"]: r["count"] for r in nodes.groupBy("shard").count().collect()}
    sizes = [held.get(s, 0) for s in range(shards)]
    # the shards holding most take the odd rows, which moves the fewest
    full = sorted(range(shards), key=lambda s: (-sizes[s], s))
    quota = [sum(sizes) // shards + (full.index(s) < sum(sizes) % shards) for s in range(shards)]
    first = [sum(sizes[:s]) for s in range(shards)]
    order = order.withColumn("slot", F.col("rank") - F.get(F.lit(first), F.col("shard")))
    stays = F.col("slot") < F.get(F.lit(quota), F.col("shard"))
    stay = order.filter(stays).drop("rank", "free")
    over = ranked(order.filter(~stays).drop("rank", "slot"), ["key", "id"], "shard-over")
    # the i-th row over quota takes the i-th free place
    to, slot, at = F.lit(None).cast("int"), F.lit(None).cast("long"), sum(
        max(0, quota[s] - sizes[s]) for s in range(shards))
    for s in reversed(range(shards)):
        free = quota[s] - sizes[s]
        if free > 0:
            at -= free
            to = F.when(F.col("rank") < at + free, F.lit(s)).otherwise(to)
            slot = F.when(F.col("rank") < at + free, F.col("rank") - at + sizes[s]).otherwise(slot)
    moved = over.withColumn("shard", to).withColumn("slot", slot).drop("rank", "free")
    return stay.unionByName(moved)


def assign(nodes: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Place ``nodes`` (id, key, any more): adds linked, shard and slot.  ``key`` names the link group.

    Rows with a null key have no links.
    """
    nodes = ranked(nodes, ["key", "id"], "shard-nodes")
    groups = (nodes.filter("key IS NOT NULL").groupBy("key")
              .agg(F.count(F.lit(1)).alias("members"), F.min("rank").alias("start")).filter("members > 1"))
    block = max(1, int(BLOCK * nodes.count() / shards))
    piece = F.floor((F.col("rank") - F.col("start")) / block).cast("int")
    groups = saved(groups, "shard-groups")
    big = F.broadcast(groups.filter(F.col("members") > block))  # at most shards / BLOCK rows
    cut = nodes.join(big, "key").withColumn("key", F.concat_ws("/", "key", piece))
    other = nodes.join(big, "key", "left_anti").join(groups.filter(F.col("members") <= block), "key", "left")
    nodes = cut.unionByName(other).withColumns({
        "linked": F.col("members").isNotNull(),
        "shard": F.pmod(F.xxhash64("id", "rank"), F.lit(shards)).cast("int")})
    nodes = saved(nodes.drop("members", "start", "rank"), "shard-start")
    nodes, apart = propagate(nodes, shards, rounds)
    logging.getLogger(__name__).info("%d linked rows are apart from most of their group before settling", apart)
    return settle(nodes, shards)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = plain(table(spark, sf_dir, "documents"), "doc_id", "text")
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    nodes = docs.select(F.col("doc_id").alias("id"), F.sha2(body, 256).alias("key"),
                        (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    return assign(nodes).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
