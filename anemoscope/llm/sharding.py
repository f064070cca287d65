"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard by a hash of its
id; then, round by round, linked documents move to the shard where most of their
neighbours are, as far as the shard's quota has room. Documents without links fill the
shards up, so that counts are at most one apart (the law ``rows``) however the
propagation went.

Only DataFrame and SQL expressions are used.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from anemoscope.llm import common

LAW = "rows"
SEED = 29
#: Rows that one block of a numbering holds, about.
BLOCK_ROWS = 2_000
#: Blocks of movers to a shard; a round admits whole blocks.
QUOTA_BLOCKS = 128
ROUNDS = 6


def numbered(rows: DataFrame, keys: list[str], order: Column, ties: list[str], total: int):
    """Adds ``__number``, gapless from 0 within each combination of ``keys``.

    Rows go to blocks of about ``BLOCK_ROWS`` by the hash ``order``; the blocks' counts give
    where each starts, so no task sorts more than a block. ``rows`` is read twice.
    """
    blocks = max(1, -(-total // BLOCK_ROWS))
    rows = rows.withColumns({"__order": order, "__block": F.pmod(order, F.lit(blocks))})
    by = [*keys, "__block"]
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.withColumn("__start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    inside = F.row_number().over(W.partitionBy(*by).orderBy("__order", *ties))
    placed = rows.withColumn("__inside", inside).join(starts.drop("n"), by)
    number = (F.col("__start") + F.col("__inside") - 1).cast("long")
    return placed.withColumn("__number", number).drop("__start", "__inside", "__order", "__block")


def quotas(total: int, shards: int) -> list[int]:
    """Rows of each shard: at most one apart."""
    return [total // shards + (s < total % shards) for s in range(shards)]


def _values(numbers: list[int]) -> Column:
    return F.array(*[F.lit(n).cast("long") for n in numbers])


def propagate(
    chunks: DataFrame, shards: int, quota: list[int], rounds: int, staging: common.Staging
) -> tuple[DataFrame, list[int]]:
    """Move chunks of linked documents; returns them with ``shard``, and each shard's load.

    A chunk is what a group (``g1``, ``g2``, ``part``) had in a shard at the start
    (``first``), with its ``n`` documents.
    """
    group = ["g1", "g2", "part"]
    chunks = chunks.withColumn("shard", F.col("first"))
    for step in range(rounds + 1):
        chunks = staging.stage(chunks, f"chunks-{step}")
        load = [0] * shards
        for r in chunks.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # one per shard
            load[r.shard] = r.n
        if step == rounds:
            break
        room = [q - x for q, x in zip(quota, load, strict=True)]
        votes = chunks.groupBy(*group, "shard").agg(F.sum("n").alias("votes"))
        free = F.element_at(_values(room), F.col("shard") + 1)
        rank = F.struct(
            (free > 0).cast("int").alias("open"), "votes",
            F.xxhash64("g1", "g2", "part", "shard").alias("tie"),
        )
        targets = votes.groupBy(*group).agg(F.max_by("shard", rank).alias("target"))
        wishes = chunks.join(targets, group)
        moving = F.col("shard") != F.col("target")
        lane = F.pmod(F.xxhash64("target", "g2", "g1", "part"), F.lit(QUOTA_BLOCKS))
        wishes = wishes.withColumn("lane", lane)
        flows = wishes.where(moving).groupBy("target", "lane").agg(F.sum("n").alias("flow"))
        upto = W.partitionBy("target").orderBy("lane").rowsBetween(W.unboundedPreceding, 0)
        admitted = flows.withColumn("sum", F.sum("flow").over(upto))
        admitted = admitted.where(
            F.col("sum") <= F.element_at(_values(room), F.col("target") + 1)
        ).select("target", "lane", F.lit(True).alias("admitted"))
        # At most shards * QUOTA_BLOCKS rows.
        moved = wishes.join(F.broadcast(admitted), ["target", "lane"], "left")
        goes = moving & F.col("admitted").isNotNull()
        if admitted.isEmpty():
            break
        chunks = moved.select(
            *group, "first", "n", F.when(goes, F.col("target")).otherwise(F.col("shard")).alias("shard")
        )
    return chunks, load


def shard(
    docs: DataFrame, staging: common.Staging, shards: int = 40, rounds: int = ROUNDS
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Equal texts are
    linked, also empty ones; null texts are linked with nothing. A group larger than half a
    shard is cut into parts of about that size. Repeated rows take a slot each. An
    empty table gives no rows. Slots are gapless from 0 in each shard.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(1), "text")).alias("g1"),
        F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(2), F.reverse("text"))).alias("g2"),
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(shards)).cast("int").alias("first"),
    )
    rows = staging.stage(rows, "rows")
    total = rows.count()
    quota = quotas(total, shards)
    groups = rows.where("g1 is not null").groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("n"))
    groups = staging.stage(groups.where("n > 1"), "groups")
    most = max(1, total // shards // 2)
    in_group = rows.join(groups, ["g1", "g2"])
    parts = F.ceil(F.col("n") / most)
    in_group = in_group.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), parts))
    in_group = staging.stage(in_group.drop("n"), "linked")
    chunks = in_group.groupBy("g1", "g2", "part", "first").agg(F.count(F.lit(1)).alias("n"))
    chunks, load = propagate(chunks, shards, quota, rounds, staging)
    placed = in_group.join(chunks.drop("n"), ["g1", "g2", "part", "first"])
    columns = ["doc_id", "size", "text_crc32"]
    order = F.xxhash64(F.lit(SEED), "doc_id", "text_crc32", "size")
    placed = staging.stage(placed.select(*columns, "shard"), "placed")
    placed = numbered(placed, ["shard"], order, columns, total)
    placed = staging.stage(placed, "slots")
    fits = F.col("__number") < F.element_at(_values(quota), F.col("shard") + 1)
    stays = placed.where(fits).select(*columns, "shard", F.col("__number").alias("slot"))
    alone = rows.join(groups, ["g1", "g2"], "left_anti").select(*columns)
    rest = alone.unionByName(placed.where(~fits).select(*columns))
    rest = numbered(rest.withColumn("__all", F.lit(0)), ["__all"], order, columns, total)
    used = [min(q, x) for q, x in zip(quota, load, strict=True)]
    ends, end = [], 0
    for q, u in zip(quota, used, strict=True):
        end += q - u
        ends.append(end)
    number = F.col("__number")
    where = F.size(F.filter(_values(ends), lambda e: e <= number))
    begin = F.element_at(_values([0, *ends]), where + 1)
    filled = F.element_at(_values(used), where + 1)
    rest = rest.select(*columns, where.alias("shard"), (number - begin + filled).alias("slot"))
    return stays.unionByName(rest)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document, counts at most one apart."""
    placed = shard(common.table(spark, sf_dir, "documents"), common.Staging(spark))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
