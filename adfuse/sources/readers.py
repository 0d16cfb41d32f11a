"""Feed readers.

CSV feeds are read as header-named strings and cast *by name* to the types
declared in the spec, so a reordered or widened header still lines up.  No
schema inference pass: that would read the data twice.

Nothing is lost silently.  A cell that does not parse as its type (12.5 as a
whole number, text as an amount) and a line with too few or too many cells
flag their row in ``bad_row`` (the default), are left out (``on_bad="drop"``)
or fail the job (``on_bad="fail"``); ``rejected_rows`` lists them, and
``checked`` counts them while the totals are computed.

Files of one feed may have their columns in different orders
(``mixed_headers=True``): a job reads the first line of every file, and the
files of each header are one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adfuse.functions.ratios import q
from adfuse.sources.files import literal, plain_path
from adfuse.sources.spec import FeedSpec

BAD_ROW = "bad_row"
#: Raw line of a record whose number of cells is wrong.
RAGGED = "_ragged_line"
#: URI of the file that a row comes from.
SOURCE_FILE = "source_file"
ON_BAD = ("flag", "drop", "fail", "ignore")


def _typed(raw: Column, dtype: str, date_format: str) -> Column:
    if dtype == "date":
        return F.try_to_date(raw, date_format)
    return raw.try_cast(dtype)


def _bad_cells(wanted: dict[str, str], date_format: str) -> dict[str, Column]:
    """Per typed column: text was present but did not parse as its type."""
    return {
        c: F.col(c).isNotNull() & _typed(F.col(c), t, date_format).isNull() for c, t in wanted.items() if t != "string"
    }


def _wanted(df: DataFrame, spec: FeedSpec, columns: Sequence[str] | None) -> dict[str, str]:
    wanted = {c: t for c, t in spec.source_types.items() if columns is None or c in columns}
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"feed {spec.name!r}: columns {missing} not found in {df.columns}")
    return wanted


def _bad_row(df: DataFrame, spec: FeedSpec, wanted: dict[str, str]) -> Column:
    """Some cell of the row does not parse, or it has too few or too many."""
    bad = reduce(lambda a, b: a | b, _bad_cells(wanted, spec.date_format).values(), F.lit(False))
    return bad | F.col(RAGGED).isNotNull() if RAGGED in df.columns else bad


def type_by_name(
    df: DataFrame,
    spec: FeedSpec,
    on_bad: str = "flag",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Cast the spec's raw columns by name; unknown extra columns are dropped.

    ``columns`` restricts the read to a subset of the spec's columns.
    ``on_bad``: "flag" adds a boolean ``bad_row``, "drop" leaves bad rows out,
    "fail" raises at the first bad row, "ignore" leaves NULL in the place of a
    bad cell.
    """
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad is one of {ON_BAD}, not {on_bad!r}")
    wanted = _wanted(df, spec, columns)
    cols = [_typed(F.col(c), t, spec.date_format).alias(c) for c, t in wanted.items()]
    if SOURCE_FILE in df.columns:
        cols.append(F.col(SOURCE_FILE))
    bad = _bad_row(df, spec, wanted)
    if on_bad == "flag":
        cols.append(bad.alias(BAD_ROW))
    elif on_bad == "drop":
        df = df.where(~bad)
    elif on_bad == "fail":
        what = F.concat(F.lit(f"feed {spec.name}: bad row "), F.to_json(F.struct(*[F.col(c) for c in wanted])))
        df = df.where(F.when(bad, F.raise_error(what)).otherwise(F.lit(True)).cast("boolean"))
    return df.select(*cols)


def _read_text(
    spark: SparkSession,
    spec: FeedSpec,
    path: str | list[str],
    header: bool = True,
    multi_line: bool = False,
    with_file: bool = False,
) -> DataFrame:
    """A CSV as text columns, with the raw line of every record of a wrong length in ``RAGGED``.

    Column names come from the first file's header (one line is read), or are
    the spec's in order for files without one.  Every other file's header is
    checked against them, so a file with a different column order fails loudly
    instead of silently shifting its values.
    """
    paths = [path] if isinstance(path, str) else list(path)
    names = spark.read.option("header", True).csv(paths).columns if header else list(spec.source_types)
    schema = ", ".join(f"{q(c)} STRING" for c in [*names, RAGGED])
    text = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAGGED)
        .option("columnPruning", False)  # else only the cells of the wanted columns would be counted
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(paths)
    )
    return text.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE)) if with_file else text


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of the partition; the rest of the file is not read."""
    for batch in batches:
        if batch.num_rows:
            first = batch.slice(0, 1)
            if first.column(2)[0].as_py() == 0:  # where the file begins
                yield first.select(["uri", "header"])
            return


def header_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header) of every non-empty file below ``paths``: its first line.

    A job with one task a file, each of which stops after a few lines.
    """
    probe = spark.newSession()  # for these settings alone
    for name in ("maxPartitionBytes", "openCostInBytes"):
        probe.conf.set(f"spark.sql.files.{name}", 1 << 40)  # files share no partition and are not split
    probe.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    lines = probe.read.option("recursiveFileLookup", True).text(list(paths))
    first = lines.select(
        F.col("_metadata.file_path").alias("uri"),
        F.ltrim("value", F.lit("\ufeff")).alias("header"),
        F.col("_metadata.file_block_start").alias("at"),
    ).mapInArrow(_first_row, "uri string, header string")
    return first.select(plain_path(F.col("uri")).alias("path"), "header")


def header_groups(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """The files below ``paths``, one list for each header among them."""
    files = header_lines(spark, paths).groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("files"))
    return [[literal(f) for f in r["files"]] for r in sorted(files.collect(), key=lambda r: r["header"])]


def _text_scans(
    spark: SparkSession, spec: FeedSpec, path, header: bool, multi_line: bool, mixed_headers: bool, with_file: bool
) -> list[DataFrame]:
    """One text scan, or one for each header among the files."""
    if not (mixed_headers and header):
        return [_read_text(spark, spec, path, header, multi_line, with_file)]
    groups = header_groups(spark, [path] if isinstance(path, str) else list(path))
    if not groups:
        raise ValueError(f"feed {spec.name!r}: no file with a header in {path}")
    return [_read_text(spark, spec, files, True, multi_line, with_file) for files in groups]


def read_feed(
    spark: SparkSession,
    spec: FeedSpec,
    path: str | list[str],
    fmt: str = "csv",
    on_bad: str = "flag",
    columns: Sequence[str] | None = None,
    header: bool = True,
    multi_line: bool = False,
    mixed_headers: bool = False,
    with_file: bool = False,
) -> DataFrame:
    """Read one channel's raw export (CSV, with or without header, or parquet).

    Paths may be files, directories or globs; many files per channel are the
    normal case at scale and are split across tasks by the file source.
    ``multi_line`` reads quoted line breaks; such a file is one task's work.
    ``mixed_headers`` takes CSV files, also in folders below the paths, whose
    headers differ in order or in extra columns: one scan for each header,
    united by name.  ``with_file`` adds ``source_file``, the URI of the row's file.
    """
    if fmt == "csv":
        scans = _text_scans(spark, spec, path, header, multi_line, mixed_headers, with_file)
        return reduce(DataFrame.unionByName, [type_by_name(s, spec, on_bad, columns) for s in scans])
    if fmt == "parquet":
        raw = spark.read.parquet(*([path] if isinstance(path, str) else path))
        if with_file:
            raw = raw.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
        if not spec.source_types:
            return raw
        return type_by_name(raw, spec, on_bad, columns)
    raise ValueError(f"unsupported feed format {fmt!r}")


#: Of ``checked``: names of its counts; those of a column's bad cells begin with ``bad:``.
READ, KEPT, FLAGGED, WRONG_COUNT, BAD_CELL = "rows_read", "rows_kept", "rows_flagged", "wrong_cell_count", "bad:"


def checked(
    spark: SparkSession,
    spec: FeedSpec,
    path: str | list[str],
    keep_bad: bool = True,
    header: bool = True,
    multi_line: bool = False,
    mixed_headers: bool = False,
) -> tuple[DataFrame, Observation]:
    """A CSV feed, and the counts of what does not parse in it.

    The counts are taken inside the same scan that the feed's totals are
    computed from (``observe``); they are there once an action on the feed has
    run, so nothing is read twice.  ``keep_bad`` leaves rows with bad cells in
    the feed, NULL in the place of those cells; else such rows are left out.
    """
    scans = _text_scans(spark, spec, path, header, multi_line, mixed_headers, False)
    wanted = _wanted(scans[0], spec, None)
    marks = _bad_cells(wanted, spec.date_format)
    typed = []
    for scan in scans:
        _wanted(scan, spec, None)
        typed.append(
            scan.select(
                *[_typed(F.col(c), t, spec.date_format).alias(c) for c, t in wanted.items()],
                _bad_row(scan, spec, wanted).alias(BAD_ROW),
                F.col(RAGGED).isNotNull().alias("_ragged"),
                *[b.alias(f"_bad_{k}") for k, b in enumerate(marks.values())],
            )
        )
    whole = reduce(DataFrame.unionByName, typed)
    counts = Observation(f"feed {spec.name}")
    whole = whole.observe(
        counts,
        F.count(F.lit(1)).alias(READ),
        (F.count(F.lit(1)) if keep_bad else F.count_if(~F.col(BAD_ROW))).alias(KEPT),
        F.count_if(F.col(BAD_ROW)).alias(FLAGGED),
        F.count_if(F.col("_ragged")).alias(WRONG_COUNT),
        *[F.count_if(F.col(f"_bad_{k}")).alias(f"{BAD_CELL}{c}") for k, c in enumerate(marks)],
    )
    if not keep_bad:
        whole = whole.where(~F.col(BAD_ROW))
    return whole.select(*wanted), counts


QUALITY = (
    "feed string, rows_read bigint, rows_kept bigint, rows_flagged bigint, wrong_cell_count bigint, "
    "bad_cells bigint, bad_columns string"
)


def feed_quality(spark: SparkSession, counts: dict[str, Observation]) -> DataFrame:
    """One row a feed of what ``checked`` counted, after an action: rows and bad cells, and columns as ``name:cells``."""
    rows = []
    for feed, seen in counts.items():
        c = seen.get
        cells = {k.removeprefix(BAD_CELL): v for k, v in c.items() if k.startswith(BAD_CELL) and v}
        named = ",".join(f"{k}:{v}" for k, v in sorted(cells.items()))
        rows.append((feed, c[READ], c[KEPT], c[FLAGGED], c[WRONG_COUNT], sum(cells.values()), named))
    return spark.createDataFrame(rows, QUALITY)


def rejected_rows(
    spark: SparkSession,
    spec: FeedSpec,
    path: str | list[str],
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """The rows of a CSV feed that are flagged, with what is wrong.

    The spec's columns as far as they parse, ``wrong_cell_count`` (the line has
    too few or too many cells), ``bad_columns`` (names of the cells that do not
    parse, comma-joined) and ``line`` (the raw line of a wrong cell count).
    """
    raw = _read_text(spark, spec, path, header, multi_line)
    wanted = _wanted(raw, spec, None)
    bad = _bad_cells(wanted, spec.date_format)
    named = F.concat_ws(",", *[F.when(b, F.lit(c)) for c, b in bad.items()])
    return raw.select(
        *[_typed(F.col(c), t, spec.date_format).alias(c) for c, t in wanted.items()],
        F.col(RAGGED).isNotNull().alias("wrong_cell_count"),
        named.alias("bad_columns"),
        F.col(RAGGED).alias("line"),
    ).where(F.col("wrong_cell_count") | (F.col("bad_columns") != ""))
