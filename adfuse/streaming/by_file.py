"""The daily roll-up from exports whose files differ in their headers.

Structured Streaming tells which files are new; each micro-batch reads just
these, one scan for each header (``read_feed(mixed_headers=True)``), and adds
their daily sums to the last published table.  So the published table is the
state: days x platforms rows, whatever the data volume.  Rows with bad cells
are counted by feed beside it, never dropped silently.  A batch is published as
a folder of its own, named by its number, with sums and counts together: a
replayed batch that is already there is left alone, so no file counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adfuse.operators.conform import conform_exprs
from adfuse.operators.rollups import daily_rollup, rollup
from adfuse.schema import DAILY_MEASURES
from adfuse.sources.files import literal, plain_path
from adfuse.sources.readers import BAD_ROW, read_feed
from adfuse.sources.spec import FeedSpec
from adfuse.sources.storage import folders, remove_folder

#: Published versions that stay for readers which have begun.
KEPT_VERSIONS = 3

Source = tuple[FeedSpec, str, str]


def new_files(spark: SparkSession, feed: str, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of (feed, path): the files that land below ``path``; no content is read."""
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(F.lit(feed).alias("feed"), plain_path(F.col("_metadata.file_path")).alias("path"))


def _version(out_path: str, batch_id: int) -> str:
    return f"{out_path.rstrip('/')}/version={batch_id:012d}"


def _published(spark: SparkSession, out_path: str) -> list[str]:
    """Versions whose sums and counts are both written; the counts are written last."""
    every = folders(spark, out_path.rstrip("/"), complete=False)
    return [f for f in every if any(x.endswith("/quality") for x in folders(spark, f))]


def read_rollup(spark: SparkSession, out_path: str) -> tuple[DataFrame, DataFrame]:
    """The newest published daily roll-up, and (feed, rows_read, rows_flagged) of all it is made of."""
    done = _published(spark, out_path)
    if not done:
        raise FileNotFoundError(f"nothing is published in {out_path} yet")
    return spark.read.parquet(f"{done[-1]}/daily"), spark.read.parquet(f"{done[-1]}/quality")


def start_rollup_by_file(
    spark: SparkSession,
    sources: Sequence[Source],
    out_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Maintain the daily roll-up of ``sources`` = [(spec, path, fmt), ...] in ``out_path``.

    ``available_now`` processes what has landed and stops; the checkpoint is by
    default a folder beside ``out_path``, the same in every run.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        session, target = batch.sparkSession, _version(out_path, batch_id)
        done = _published(session, out_path)
        if any(f.endswith(target.rpartition("/")[2]) for f in done):
            return
        landed: dict[str, list[str]] = {}
        for r in batch.collect():  # names of the batch's files, for the readers
            landed.setdefault(r["feed"], []).append(literal(r["path"]))
        sums, counts = [], []
        for spec, _, fmt in sources:
            if spec.name in landed:
                mixed = {"mixed_headers": True} if fmt == "csv" else {}
                raw = read_feed(session, spec, landed[spec.name], fmt, **mixed)
                rows = raw.selectExpr(*conform_exprs(raw, spec), BAD_ROW, f"'{spec.name}' AS feed")
                both = rows.groupBy("feed", "date", "platform").agg(
                    *[F.expr(f"coalesce(sum({m}), 0) AS {m}") for m in DAILY_MEASURES],
                    F.count(F.lit(1)).alias("rows_read"),
                    F.count_if(BAD_ROW).alias("rows_flagged"),
                )
                path = f"{target}/feed-{len(sums)}"
                both.write.mode("overwrite").parquet(path)  # one pass over the files gives sums and counts
                both = session.read.schema(both.schema).parquet(path)
                sums.append(both.select("date", "platform", *DAILY_MEASURES))
                counts.append(both.select("feed", "rows_read", "rows_flagged"))
        if done:
            sums.append(session.read.parquet(f"{done[-1]}/daily").select("date", "platform", *DAILY_MEASURES))
            counts.append(session.read.parquet(f"{done[-1]}/quality"))
        if sums:
            daily = daily_rollup(reduce(DataFrame.union, sums))
            daily.hint("rebalance").write.mode("overwrite").parquet(f"{target}/daily")
            quality = rollup(reduce(DataFrame.union, counts), ["feed"], ["rows_read", "rows_flagged"])
            quality.coalesce(1).write.mode("overwrite").parquet(f"{target}/quality")
        for old in folders(session, out_path, complete=False)[:-KEPT_VERSIONS]:
            remove_folder(session, old)

    files = [new_files(spark, spec.name, path, max_files_per_trigger) for spec, path, _ in sources]
    writer = (
        reduce(DataFrame.union, files)
        .writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint or f"{out_path.rstrip('/')}-checkpoint")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
