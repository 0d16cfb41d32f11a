"""The daily (date x platform) roll-up, maintained incrementally as feed files land.

Same conform specs and the same ``daily_rollup`` as the batch plans, run by
Structured Streaming.  The result has one row per (date, platform): its size
is days x platforms, independent of data volume.  That bounds the streaming
state, so no watermark is needed to evict it, and no row is ever dropped:
data arriving late for an old day still lands in that day's totals.  Each
micro-batch publishes the whole (small) table as a folder of its own, so a
reader (``read_daily_rollup``) always finds a complete table, also while a
batch is being written or after one failed; a replayed batch that is already
complete is left alone.  Progress lives in a checkpoint beside the published
table, so scheduled ``availableNow`` runs resume where they stopped.  Trailing
averages are then a batch window over the published table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adfuse.functions.ratios import q
from adfuse.operators.conform import conform, unify
from adfuse.operators.rollups import daily_rollup
from adfuse.sources.readers import RAGGED, type_by_name
from adfuse.sources.spec import FeedSpec
from adfuse.sources.storage import folders, remove_folder


def read_feed_stream(
    spark: SparkSession,
    spec: FeedSpec,
    path: str,
    fmt: str = "csv",
    max_files_per_trigger: int | None = None,
    on_bad: str = "flag",
) -> DataFrame:
    """Streaming read of a channel's export folder.

    Streaming CSV applies the schema by position, so the spec's column order
    must match the files' header; ``enforceSchema=false`` makes a mismatching
    header fail loudly instead of shifting columns (``streaming.by_file`` takes
    such files).  ``on_bad`` as in the batch reader: a cell that does not parse
    and a line with too few or too many cells flag their row in ``bad_row``.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        ddl = ", ".join(f"{q(c)} STRING" for c in [*spec.source_types, RAGGED])
        raw = (
            reader.schema(ddl)
            .option("header", True)
            .option("enforceSchema", False)
            .option("columnNameOfCorruptRecord", RAGGED)
            .option("columnPruning", False)
            .option("escape", '"')
            .csv(path)
        )
    elif fmt == "parquet":
        ddl = ", ".join(f"{q(c)} {t}" for c, t in spec.source_types.items())
        raw = reader.schema(ddl).parquet(path)
    else:
        raise ValueError(f"unsupported feed format {fmt!r}")
    return type_by_name(raw, spec, on_bad)


#: Published versions that stay for readers which have begun.
KEPT_VERSIONS = 3


def _version(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/version={batch_id:012d}"


def read_daily_rollup(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest completely published daily roll-up."""
    done = folders(spark, out_path)
    if not done:
        raise FileNotFoundError(f"nothing is published in {out_path} yet")
    return spark.read.parquet(done[-1])


def write_daily_rollup(
    fact: DataFrame,
    out_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str = "1 minute",
) -> StreamingQuery:
    """Start the incremental daily roll-up of a streaming fact into ``out_path``.

    ``available_now`` processes what has landed and stops (scheduled runs);
    otherwise it runs continuously every ``processing_time``.  The checkpoint
    is by default a folder beside ``out_path``, the same in every run.  The
    published table is rebalanced, so the number of files follows its size.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        target = _version(out_path, batch_id)
        if not any(f.endswith(target.rpartition("/")[2]) for f in folders(session, out_path)):
            batch.hint("rebalance").write.mode("overwrite").parquet(target)
        for old in folders(session, out_path)[:-KEPT_VERSIONS]:
            remove_folder(session, old)

    writer = (
        daily_rollup(fact)
        .writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint or f"{out_path.rstrip('/')}-checkpoint")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def start_daily_rollup(
    spark: SparkSession,
    sources: Sequence[tuple[FeedSpec, str, str]],
    out_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str = "1 minute",
) -> StreamingQuery:
    """Start the incremental daily roll-up of ``sources`` = [(spec, path, fmt), ...]."""
    fact = unify(conform(read_feed_stream(spark, spec, path, fmt), spec) for spec, path, fmt in sources)
    return write_daily_rollup(fact, out_path, checkpoint, available_now, processing_time)
