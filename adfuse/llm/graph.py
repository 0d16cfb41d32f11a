"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfuse.llm.tables import table_at
from adfuse.sources.storage import remove_scratch, scratch_path

#: Edges that one partition of a round's tables holds, on average.
EDGES = 20_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _written(df: DataFrame, tasks: int | None = None) -> tuple[DataFrame, str]:
    """The table, written to the shared folder in so many files, and where it lies."""
    path = scratch_path(df.sparkSession, "edges")
    (df.coalesce(tasks) if tasks else df).write.parquet(path)
    return table_at(df, path), path


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of an edge; root is the smallest id reachable.

    ``edges`` has two bigint columns, in any direction.  Large stars connect
    the larger neighbours of a node to the smallest one, small stars the
    smaller ones; a few rounds (logarithmic in the longest chain) turn every
    component into one star around its smallest node.  The minimum of a node's
    neighbours is a partial aggregation, and it is written out before the edges
    join it, so that adaptive execution may split the partition of a node with
    very many edges.  Every round's table is written to the shared folder in as
    many files as its rows call for, and then the one before it is removed.
    """
    a, b = edges.columns
    spark = edges.sparkSession
    now, path = _written(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    state = _state(now)
    while True:
        tasks = max(1, math.ceil(2 * state[0] / EDGES))
        both = now.union(now.select("v", "u"))
        low, low_path = _written(both.groupBy("u").agg(F.min("v").alias("m")), tasks)
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = large.coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, new_path = _written(
            least.select("u", F.col("m").alias("v")).union(small).coalesce(tasks).distinct(), tasks
        )
        remove_scratch(spark, low_path)
        remove_scratch(spark, path)
        now, path, before = after, new_path, state
        state = _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
