"""Tables in one global order, as parts that follow one another: pages of a table, and one large CSV.

Rows are dealt out by range, so no task sorts or writes them all.  A listing
says how many rows, or bytes, lie in front of each part.
"""

from __future__ import annotations

import io
import json
from collections.abc import Sequence
from csv import writer
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfuse.functions.ratios import q
from adfuse.sources.files import file_states, literal
from adfuse.sources.sinks import CSV_OPTIONS

_PART = "_part"


def _order(df: DataFrame, by: Sequence[str]) -> list[Column]:
    """``by``, then all other columns, so that only equal rows tie; NULL comes first."""
    return [F.col(q(c)).asc_nulls_first() for c in [*by, *(c for c in df.columns if c not in by)]]


def _in_order(df: DataFrame, by: Sequence[str], parts: int | None) -> DataFrame:
    order = _order(df, by)
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order)


# --- pages ------------------------------------------------------------------------
@dataclass(frozen=True)
class Paged:
    """A stored table in order, and how many rows lie before each of its parts."""

    path: str
    schema: str  # as JSON
    by: tuple[str, ...]

    def _parts(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{_PART} INT, n BIGINT, before BIGINT").parquet(f"{self.path}/parts")

    def rows(self, spark: SparkSession) -> int:
        return self._parts(spark).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def page(self, spark: SparkSession, number: int, size: int) -> DataFrame:
        """Rows ``number * size`` and following, at most ``size``, in order.

        Only the parts that hold some of them are opened: one or two, if a
        page is smaller than a part.
        """
        first = number * size
        held = self._parts(spark).where((F.col("before") < first + size) & (F.col("before") + F.col("n") > first))
        parts = sorted(held.collect(), key=lambda r: r["before"])
        schema = T.StructType.fromJson(json.loads(self.schema))
        if not parts:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).parquet(*[f"{self.path}/rows/{_PART}={r[_PART]}" for r in parts])
        return rows.orderBy(*_order(rows, self.by)).offset(first - parts[0]["before"]).limit(size)


def store_pages(df: DataFrame, path: str, by: Sequence[str], parts: int | None = None) -> Paged:
    """Store ``df`` in the order of ``by`` (ties by all other columns), for reading page by page.

    ``parts`` is the number of parts, by default that of the session's shuffle partitions.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    _in_order(df, by, parts).withColumn(_PART, F.spark_partition_id()).write.partitionBy(_PART).parquet(f"{path}/rows")
    stored = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(_PART, T.IntegerType())]))
    counts = stored.parquet(f"{path}/rows").groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))  # a row for each part
    counts.select(_PART, "n", F.coalesce(before, F.lit(0)).alias("before")).write.parquet(f"{path}/parts")
    return Paged(path, df.schema.json(), tuple(by))


# --- one CSV ------------------------------------------------------------------------
def export_ordered_csv(df: DataFrame, path: str, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """Write ``df`` as one CSV in parts: their bytes, one after another, are the file.

    The first part is the header line.  Returns (and stores as ``manifest``)
    place, path, length and offset of every part; whoever downloads the file
    streams the parts in this order, or a range of bytes from those that hold
    it.  Rows are in the order of ``by``, ties by all other columns.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    line = io.StringIO()
    writer(line, lineterminator="").writerow(df.columns)
    spark.range(1).select(F.lit(line.getvalue()).alias("value")).coalesce(1).write.text(f"{path}/header")
    body = _in_order(df, by, parts).write.options(**{**CSV_OPTIONS, "header": False}, nullValue="", emptyValue='""')
    body.csv(f"{path}/rows")
    files = file_states(spark, [literal(f"{path}/header"), literal(f"{path}/rows")]).where("length > 0")
    order = Window.orderBy(~F.col("path").contains("/header/part-"), "path")  # a row for each part
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    listed = files.select(
        (F.row_number().over(order) - 1).alias("place"), "path", "length", F.coalesce(before, F.lit(0)).alias("offset")
    )
    listed.coalesce(1).write.parquet(f"{path}/manifest")
    return spark.read.schema(listed.schema).parquet(f"{path}/manifest")
