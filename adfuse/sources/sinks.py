"""Sinks: CSV export of the (filtered) fact and parquet materialisation."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfuse.functions.ratios import q
from adfuse.schema import FACT_SCHEMA


# How CSV is written and read, so that any text survives and other
# tools (spreadsheets, Python's csv module) read the files.
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "dateFormat": "yyyy-MM-dd",
    "header": True,
}
#: Stands for an empty cell without quotes while reading, so that "" stays an empty text.
_NO_CELL = "\u0000"


def export_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", rows_per_file: int = 2_000_000
) -> str:
    """Write ``df`` as header CSV with ISO dates (parallel files of at most ``rows_per_file`` rows).

    Quotes are doubled, blanks and line breaks kept; NULL is an empty cell, an
    empty text is ``""``.  The reference offers the filtered fact as a single
    downloadable CSV; at scale we write a directory of part files rather than
    funnel the data through one task or the driver.  Files are bounded because
    a reader cannot split one that holds line breaks.
    """
    (
        df.write.mode(mode)
        .options(**CSV_OPTIONS, nullValue="", emptyValue='""', maxRecordsPerFile=rows_per_file)
        .csv(path)
    )
    return path


def read_csv_typed(
    spark: SparkSession, path: str, schema: T.StructType = FACT_SCHEMA, multi_line: bool = True, header: bool = True
) -> DataFrame:
    """Read a CSV written by ``export_csv`` back, typed by header name.

    The column order is known, so the text schema is given up front (no
    header-inference job) and every file's header is validated against it.
    ``multi_line=False`` lets large files be split, for texts without line
    breaks.  A cell that is there but does not parse as its type fails the job.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(text)
        .options(**{**CSV_OPTIONS, "header": header}, nullValue=_NO_CELL, emptyValue="", multiLine=multi_line)
        .option("enforceSchema", False)
        .csv(path)
    )
    cols = []
    for f in schema.fields:
        cell = F.col(q(f.name))
        if isinstance(f.dataType, T.StringType):
            cols.append(cell)
            continue
        value = F.try_to_date(cell, "yyyy-MM-dd") if isinstance(f.dataType, T.DateType) else cell.try_cast(f.dataType)
        lost = F.raise_error(F.concat(F.lit(f"{f.name}: no {f.dataType.simpleString()}: "), cell)).cast(f.dataType)
        cols.append(F.when(cell.isNotNull() & value.isNull(), lost).otherwise(value).alias(f.name))
    return raw.select(*cols)


@dataclass(frozen=True)
class Stored:
    """A parquet table and how to read it: no schema is inferred, partition columns included."""

    path: str
    schema: str  # as JSON
    partition_by: tuple[str, ...] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schema))
        table = spark.read.schema(schema).parquet(self.path)
        texts = _text_parts(schema, self.partition_by)
        return table.select(*[F.expr(f"substring({q(c)}, 2)").alias(c) if c in texts else F.col(q(c)) for c in schema.names])


def _text_parts(schema: T.StructType, partition_by: Sequence[str]) -> set[str]:
    return {c for c in partition_by if isinstance(schema[c].dataType, T.StringType)}


def store(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    bloom: Sequence[str] = (),
    row_group_bytes: int = 32 << 20,
    mode: str = "errorifexists",
) -> Stored:
    """Write ``df`` as parquet; ``read()`` of the result gives it back.

    ``partition_by`` makes folders that filters prune.  Rows are dealt out by
    these columns with ``rebalance``: adaptive execution splits a folder that
    holds much of the table into several tasks, and merges small ones.
    ``cluster_by`` sorts inside them, so that each row group spans few values
    and filters skip the others; columns of ``bloom`` get bloom filters for
    values inside a row group's span.  Texts of partition columns are written
    behind a ``=``, so that an empty text is not taken for NULL.
    """
    texts = _text_parts(df.schema, partition_by)
    out = df.select(*[F.concat(F.lit("="), F.col(q(c))).alias(c) if c in texts else F.col(q(c)) for c in df.columns])
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    if partition_by or cluster_by:
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    writer = out.write.mode(mode).option("parquet.block.size", row_group_bytes)
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return Stored(path, df.schema.json(), tuple(partition_by))


def materialize(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> DataFrame:
    """Persist ``df`` as parquet and return a DataFrame reading it back.

    Replaces the reference's in-process cache: the written table survives
    executor loss, cuts lineage for the many downstream consumers, and
    ``partition_by=["platform"]`` gives partition pruning for platform filters.
    """
    return store(df, path, partition_by or (), mode=mode).read(df.sparkSession)
