"""Balanced contiguous shards by global byte prefix sums.

Rows are put in one global order (digest of the text, then ``doc_id``), so
equal texts stand together.  Each range partition sums its own sizes; the
running total of these few sums is the offset of every partition, and offset
plus running sum inside the partition is the global prefix of a row.  Shard
boundaries are the equal byte targets.  A target that falls into a group of
equal texts moves to the nearer edge of the group if that edge is no further
than ``snap`` of a shard; a larger group is cut at the target itself, so one
huge group cannot unbalance the shards.

Nothing but (id, size, checksum, digest) is shuffled: texts are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adfuse.llm.tables import checkpointed, pick


def positions(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``prefix`` (bytes before the row) and ``row`` (rows before it).

    ``rows`` has ``size`` and the ``order`` columns.  A range partitioning
    splits even a single hot key, because a row number is the last sort key.
    The checkpoint fixes which row lies in which partition, for the two reads
    that follow and for a recovery after a lost executor.
    """
    keys = [*order, "_tie"]
    dealt = checkpointed(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .withColumn("_part", F.spark_partition_id())
    )
    # One row per range partition: as many as the session has shuffle partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_part")
        .agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes0"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows0"),
        )
    )
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        dealt.withColumn("_sum", F.sum("size").over(inside))
        .withColumn("_nth", F.count(F.lit(1)).over(inside))
        .join(offsets, "_part")
        .withColumn("prefix", F.col("_bytes0") + F.col("_sum") - F.col("size"))
        .withColumn("row", F.col("_rows0") + F.col("_nth") - 1)
        .drop("_part", "_tie", "_sum", "_nth", "_bytes0", "_rows0")
    )


def cut_points(placed: DataFrame, shards: int, snap: float) -> list[int]:
    """The inner shard boundaries, in bytes; at most ``shards - 1`` rows reach the driver."""
    total = placed.agg(F.max(F.col("prefix") + F.col("size"))).first()[0]
    if not total:
        return []
    targets = [total * k // shards for k in range(1, shards)]
    nth = F.floor(F.col("prefix") * shards / F.lit(total))
    hit = placed.where(F.floor((F.col("prefix") + F.col("size")) * shards / F.lit(total)) >= nth + 1)
    # At most one row per target holds it, so this side has fewer than `shards` rows.
    edges = (
        placed.join(F.broadcast(hit.select("digest").distinct()), "digest")
        .groupBy("digest")
        .agg(F.min("prefix").alias("low"), F.max(F.col("prefix") + F.col("size")).alias("high"))
        .collect()
    )
    out = []
    for t in targets:
        near = min((abs(e - t), e) for g in edges for e in (g["low"], g["high"])) if edges else (total, t)
        out.append(near[1] if near[0] <= snap * total / shards else t)
    return sorted(out)


def shard(docs: DataFrame, shards: int = 16, snap: float = 0.02) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into one of ``shards`` shards.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32,
    shard and slot (0, 1, ... inside the shard).  A null text counts as empty
    (size 1, checksum 0); a null doc_id sorts first among equal texts; a row
    that is repeated gets a slot for each of its copies; an empty table gives
    no rows.  A document larger than a shard leaves other shards empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = pick(docs, ("doc_id", "bigint"), ("text", "string")).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("digest"),
    )
    placed = checkpointed(positions(rows, "digest", "doc_id"))
    middle = F.col("prefix") * 2 + F.col("size")
    number = F.lit(0)
    for cut in cut_points(placed, shards, snap):
        number = number + F.when(middle >= 2 * cut, 1).otherwise(0)
    placed = placed.withColumn("shard", number.cast("int"))
    first = placed.groupBy("shard").agg(F.min("row").alias("_first"))
    # One row per shard.
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("_first")).alias("slot")
    )


def op10_byte_shards(spark, sf_dir) -> DataFrame:
    from adfuse.llm.tables import table

    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
