"""Shards of equal row counts that keep equal texts together, by balanced label propagation.

Documents with equal texts are linked. Every document starts on a shard by hash; round by round, joins
tell each community of linked documents where its members stand, and communities move to the shard
most of them are on, as far as the quotas of the shards allow; who was refused turns to where there
is room. Single documents and what never found room then fill all shards to the same count.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.tables import stored

SHARDS = 24
ROUNDS = 8
SHARE = 4  # a community holds about a shard's quota divided by this, at most; larger groups are several
ORDERS = 64  # communities of about one size are admitted in so many batches
PART = 33  # bits of a row's place within its partition in a monotonically increasing id


def ranked(df: DataFrame, columns: list[str], purpose: str) -> DataFrame:
    """``df`` with ``rank``, counted from 0 in the order of ``columns``, without a window over all rows.

    Rows are sorted in ranges, and only the ranges' row counts meet on the driver.
    """
    ordered = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    placed = stored(ordered.withColumn("_place", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_place", PART)
    counts = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("part")).count().collect())
    before = np.cumsum([0] + [n for _, n in counts]).tolist()
    offsets = [(p, b) for (p, _), b in zip(counts, before, strict=False)]
    starts = df.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint")
    placed = placed.withColumn("_part", part).join(starts, "_part")
    rank = F.col("_before") + F.col("_place").bitwiseAND((1 << PART) - 1)
    return placed.withColumn("rank", rank).drop("_place", "_part", "_before")


def admitted(asked: dict[tuple[int, int], int], free: np.ndarray) -> list[tuple[int, int]]:
    """Which batches ``(shard, order)`` of ``asked`` rows fit the shards' free places, in order; takes them from ``free``."""
    taken = []
    for (shard, order), rows in sorted(asked.items()):
        if rows <= free[shard]:
            free[shard] -= rows
            taken.append((shard, order))
    return taken


def propagate(communities: DataFrame, quotas: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``(community, shard)`` for those that found room, and the places left on each shard.

    ``communities`` has ``(community, shard, rows)``: how many members stand on each shard now.
    """
    spark = communities.sparkSession
    free = quotas.copy()
    waiting = stored(communities, "communities")
    settled: DataFrame | None = None
    for turn in range(rounds):
        room = spark.createDataFrame([(s, int(n)) for s, n in enumerate(free)], "shard int, room bigint")
        total = waiting.groupBy("community").agg(F.sum("rows").alias("size"))
        # Where most members stand, of the shards with room for all; else a shard drawn in proportion to its room.
        votes = waiting.join(total, "community").join(room, "shard").filter("room >= size")
        wish = votes.groupBy("community").agg(F.max(F.struct("rows", F.xxhash64("community", "shard"), "shard")).alias("best"))
        bounds = np.cumsum(np.maximum(free, 0))
        drawn = F.pmod(F.xxhash64("community", F.lit(turn)), F.lit(int(max(bounds[-1], 1))))
        by_room = F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]), lambda b: b <= drawn))
        asked = total.join(wish, "community", "left").select(
            "community",
            "size",
            F.coalesce("best.shard", by_room).cast("int").alias("shard"),
            ((31 - F.floor(F.log2("size"))) * ORDERS + F.pmod(F.xxhash64("community"), F.lit(ORDERS))).cast("int").alias("order"),
        )
        asked = stored(asked, "asked")
        # Shards times sizes (by powers of two) times batches: a bounded number of rows.
        sums = {(r["shard"], r["order"]): r["rows"] for r in asked.groupBy("shard", "order").agg(F.sum("size").alias("rows")).collect()}
        if not sums:
            break
        taken = spark.createDataFrame(admitted(sums, free), "shard int, order int")
        moved = stored(asked.join(taken, ["shard", "order"]).select("community", "shard"), "moved")
        settled = moved if settled is None else settled.union(moved)
        waiting = stored(waiting.join(moved.select("community"), "community", "left_anti"), "communities")
    if settled is None:
        settled = spark.createDataFrame([], "community bigint, shard int")
    return settled, free


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, size, text_crc32, shard, slot)`` for every row; row counts of shards differ by one at most.

    ``size`` is the text's UTF-8 bytes plus 8. Slots count from 0 without gaps on every shard. A null
    text counts as empty, and empty texts are equal texts. Rows may repeat ids; equal rows are linked
    like any equal texts. An empty table gives an empty result; other columns are not read.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("_text"),
    )
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = stored(rows.groupBy("_text").agg(F.count("*").alias("_n")), "groups")
    number = groups.agg(F.sum("_n")).head()[0] or 0
    quotas = np.array([number // shards + (s < number % shards) for s in range(shards)])
    most = max(1, int(quotas[0]) // SHARE)
    # Groups larger than a community may be fall into several, whose members start out near each other.
    linked = groups.filter("_n > 1").withColumn("_parts", F.ceil(F.col("_n") / most).cast("int"))
    part = F.pmod(F.xxhash64("_row"), F.col("_parts")).cast("int")
    community = F.xxhash64("_text", part)
    together = F.pmod(F.pmod(F.xxhash64("_text"), F.lit(shards)) + F.floor(part / SHARE), F.lit(shards))
    start = F.when(F.col("_parts") > 1, together).otherwise(F.pmod(F.xxhash64("_row"), F.lit(shards))).cast("int")
    members = stored(rows.join(linked, "_text").select("_row", community.alias("community"), start.alias("shard")), "members")
    settled, free = propagate(members.groupBy("community", "shard").agg(F.count("*").alias("rows")), quotas)
    settled = members.select("_row", "community").join(settled, "community", "left")
    placed = rows.select("id", "size", "text_crc32", "_row").join(settled, "_row", "left")
    placed = placed.select(
        "id", "size", "text_crc32", "_row", F.coalesce("shard", F.lit(shards)).alias("_section"), F.coalesce("community", F.lit(0)).alias("_community")
    )
    found = ranked(placed, ["_section", "_community", "_row"], "placed")
    # Settled rows stand first, shard by shard; the others fill what is free, in order.
    used = quotas - free
    begins, fills = np.cumsum(used) - used, np.cumsum(free)
    rest = F.col("rank") - F.lit(int(used.sum()))
    filled = F.size(F.filter(F.array(*[F.lit(int(x)) for x in fills]), lambda x: x <= rest))

    def of(values: np.ndarray, shard: Column) -> Column:
        return F.get(F.array(*[F.lit(int(x)) for x in values]), shard)

    loose = F.col("_section") == shards
    shard = F.when(loose, filled).otherwise(F.col("_section"))
    slot = F.when(loose, rest - of(fills - free, filled) + of(used, filled)).otherwise(F.col("rank") - of(begins, F.col("_section")))
    return found.select("id", "size", "text_crc32", shard.cast("int").alias("shard"), slot.cast("bigint").alias("slot"))
