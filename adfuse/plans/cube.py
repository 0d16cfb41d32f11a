"""The campaign-day table, kept up to date by reading changed files only.

Every source file has partial sums of its own by date, platform and campaign.
Sums are additive, so a file that is replaced or deleted is taken back by
leaving out its partial sums: nothing is subtracted, and all sums are exact, so
no error builds up from refresh to refresh.  A refresh

1. compares the listing of all exports with that of the last version;
2. reads the new and the changed files, once;
3. rewrites the platform-months (``slices``) that these files, or files that
   are gone, have a part in; all other slices stay the files they were;
4. publishes the new version: its listing and where each slice lies.

A reader takes a version as a whole, also while the next one is written, and a
broken-off refresh changes nothing.  Folders of old versions stay for readers
until ``evict``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfuse.operators.conform import conform_exprs
from adfuse.operators.filters import DateLike, filter_fact
from adfuse.operators.rollups import campaign_day_rollup, rollup
from adfuse.schema import FACT_TYPES, PLATFORM_MEASURES
from adfuse.sources.files import file_states, literal, spec_text
from adfuse.sources.readers import BAD_ROW, SOURCE_FILE, read_feed
from adfuse.sources.spec import FeedSpec
from adfuse.sources.storage import folders, remove_folder

_KEYS = ["date", "platform", "campaign_name"]
CUBE = T.StructType([T.StructField(c, FACT_TYPES[c]) for c in [*_KEYS, *PLATFORM_MEASURES]])
SLICE = "slice"
#: Rows of a file with a cell that does not parse (their other cells count).
BAD_ROWS = "bad_rows"
_PARTIALS = T.StructType([T.StructField(SOURCE_FILE, T.StringType()), *CUBE.fields, T.StructField(BAD_ROWS, T.LongType())])
_FILES = "feed STRING, spec STRING, uri STRING, path STRING, length BIGINT, modified TIMESTAMP"
_FILE_SLICES = f"uri STRING, {SLICE} STRING"
_SLICES = f"{SLICE} STRING, platform STRING, month INT, folder STRING"


@dataclass(frozen=True)
class Export:
    """The folder of one channel's export files; CSV headers may differ from file to file."""

    spec: FeedSpec
    path: str
    fmt: str = "csv"


@dataclass(frozen=True)
class Refresh:
    """What a refresh did."""

    version: str
    files_read: int
    files_gone: int
    slices_written: int


def _slice(platform: Column, date: Column) -> Column:
    """Names a platform-month in a folder name; rows without date are a slice of their own."""
    month = F.coalesce(F.year(date) * 100 + F.month(date), F.lit(0))
    return F.concat_ws("_", F.hex(F.coalesce(platform, F.lit(""))), month)


class _State:
    """The published tables of one version; a version without folder is empty."""

    def __init__(self, spark: SparkSession, version: str | None) -> None:
        self.spark, self.version = spark, version

    def _table(self, name: str, schema: str) -> DataFrame:
        if self.version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.version}/{name}")

    @property
    def files(self) -> DataFrame:
        return self._table("files", _FILES)

    @property
    def file_slices(self) -> DataFrame:
        return self._table("file_slices", _FILE_SLICES)

    @property
    def slices(self) -> DataFrame:
        return self._table("slices", _SLICES)


def _last(spark: SparkSession, root: str) -> _State:
    done = [f for f in folders(spark, f"{root}/versions", complete=False) if _published(spark, f)]
    return _State(spark, done[-1] if done else None)


def _published(spark: SparkSession, version: str) -> bool:
    return any(f.endswith("/slices") for f in folders(spark, version))  # written last


def _partials(spark: SparkSession, exports: Sequence[Export], changed: dict[str, list[str]]) -> DataFrame | None:
    """Partial sums of the changed files, by file."""
    parts = []
    for e in exports:
        paths = [literal(p) for p in changed.get(e.spec.name, [])]
        if paths:
            mixed = {"mixed_headers": True} if e.fmt == "csv" else {}
            raw = read_feed(spark, e.spec, paths, e.fmt, with_file=True, **mixed)
            bad = f"CAST({BAD_ROW} AS BIGINT) AS {BAD_ROWS}"
            parts.append(raw.selectExpr(*conform_exprs(raw, e.spec), SOURCE_FILE, bad))
    if not parts:
        return None
    return rollup(reduce(DataFrame.union, parts), [SOURCE_FILE, *_KEYS], [*PLATFORM_MEASURES, BAD_ROWS], exact=True)


def _read_slices(spark: SparkSession, root: str, kind: str, slices: Sequence, schema: T.StructType) -> DataFrame:
    """The rows of the named slices, from wherever they lie."""
    paths = [f"{root}/{kind}/{s['folder']}/{SLICE}={s[SLICE]}" for s in slices]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _write_slices(rows: DataFrame, path: str, slices: int) -> None:
    """A folder for each slice, dealt out by range: a slice with many rows is many tasks' work."""
    order = [SLICE, "campaign_name", "date"]
    tasks = max(1, min(slices, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = rows.withColumn(SLICE, _slice(F.col("platform"), F.col("date"))).repartitionByRange(tasks, *order)
    dealt.sortWithinPartitions(*order).write.partitionBy(SLICE).parquet(path)


def refresh_cube(spark: SparkSession, exports: Sequence[Export], root: str) -> Refresh:
    """Bring the campaign-day table below ``root`` up to date with the exports.

    A file is changed if its length or modification time is, or its feed's
    spec.  An export that is not passed any more counts as deleted.  Without
    any change nothing is written.  One refresh at a time.
    """
    root = root.rstrip("/")
    old = _last(spark, root)
    listed = [
        file_states(spark, [e.path]).select(
            F.lit(e.spec.name).alias("feed"), F.lit(spec_text(e.spec)).alias("spec"), "uri", "path", "length", "modified"
        )
        for e in exports
    ]
    version = f"{root}/versions/{uuid.uuid1().time:020d}"
    empty = spark.createDataFrame([], _FILES)
    reduce(DataFrame.union, listed, empty).write.parquet(f"{version}/files")  # listed once: what follows sees one state
    now = spark.read.schema(_FILES).parquet(f"{version}/files")
    same = ["feed", "spec", "uri", "length", "modified"]
    fresh = now.join(old.files.select(*same), same, "left_anti")
    gone = old.files.join(now.select(*same), same, "left_anti").select("uri")
    changed: dict[str, list[str]] = {}
    for r in fresh.select("feed", "path").collect():  # paths that the readers are given
        changed.setdefault(r["feed"], []).append(r["path"])
    n_read, n_gone = sum(map(len, changed.values())), gone.count()
    if not n_read and not n_gone and old.version:
        remove_folder(spark, version)
        return Refresh(old.version, 0, 0, 0)

    key = uuid.uuid4().hex
    incoming = spark.createDataFrame([], _PARTIALS)
    parts = _partials(spark, exports, changed)
    if parts is not None:
        parts.select(*_PARTIALS.names).write.parquet(f"{root}/incoming/{key}")  # the files are read here, and only here
        incoming = spark.read.schema(_PARTIALS).parquet(f"{root}/incoming/{key}")
    new_slices = incoming.select(F.col(SOURCE_FILE).alias("uri"), _slice(F.col("platform"), F.col("date")).alias(SLICE))
    touched = new_slices.select(SLICE).union(old.file_slices.join(gone, "uri", "left_semi").select(SLICE)).distinct()
    touched = {r[SLICE] for r in touched.collect()}  # platform-months
    before = old.slices.collect()
    stale = _read_slices(spark, root, "partials", [s for s in before if s[SLICE] in touched], _PARTIALS)
    stay = stale.join(gone, stale[SOURCE_FILE] == gone["uri"], "left_anti").select(*_PARTIALS.names)
    _write_slices(stay.union(incoming), f"{root}/partials/{key}", len(touched))
    partials = spark.read.schema(_PARTIALS).parquet(f"{root}/partials/{key}")
    _write_slices(campaign_day_rollup(partials, exact=True), f"{root}/cube/{key}", len(touched))

    (
        old.file_slices.join(gone, "uri", "left_anti").union(new_slices).distinct()
        .write.parquet(f"{version}/file_slices")
    )
    cube = spark.read.schema(CUBE).parquet(f"{root}/cube/{key}")
    date = F.col("date")
    written = cube.select(
        _slice(F.col("platform"), date).alias(SLICE),
        "platform",
        (F.year(date) * 100 + F.month(date)).alias("month"),
        F.lit(key).alias("folder"),
    ).distinct()
    kept = spark.createDataFrame([tuple(s) for s in before if s[SLICE] not in touched], _SLICES)
    kept.union(written).coalesce(1).write.parquet(f"{version}/slices")
    if parts is not None:
        remove_folder(spark, f"{root}/incoming/{key}")
    return Refresh(version, n_read, n_gone, len(touched))


def read_cube(
    spark: SparkSession,
    root: str,
    platforms: Sequence[str] | None = None,
    date_from: DateLike = None,
    date_to: DateLike = None,
    campaigns: Sequence[str] | None = None,
) -> DataFrame:
    """The newest version of the campaign-day table, filtered as the fact is; other platform-months are not opened."""
    root = root.rstrip("/")
    state = _last(spark, root)
    if state.version is None:
        raise FileNotFoundError(f"nothing is published in {root} yet")
    first = F.col("month") * 100 + 1
    days = [F.lit(d).cast("date") for d in (date_from, date_to if date_to is not None else date_from)]
    wanted = state.slices if platforms is None else state.slices.where(F.col("platform").isin(list(platforms)))
    if date_from is not None:
        wanted = wanted.where(first >= F.year(days[0]) * 10000 + F.month(days[0]) * 100 + 1)
    if date_from is not None or date_to is not None:
        wanted = wanted.where(first <= F.year(days[1]) * 10000 + F.month(days[1]) * 100 + 1)
    cube = _read_slices(spark, root, "cube", wanted.collect(), CUBE)
    return filter_fact(cube, platforms, date_from, date_to, campaigns)


def bad_rows(spark: SparkSession, root: str) -> DataFrame:
    """(source_file, bad_rows) of the files of the newest version that have rows with bad cells."""
    root = root.rstrip("/")
    rows = _read_slices(spark, root, "partials", _last(spark, root).slices.collect(), _PARTIALS)
    return rows.groupBy(SOURCE_FILE).agg(F.sum(BAD_ROWS).alias(BAD_ROWS)).where(f"{BAD_ROWS} > 0")


def evict(spark: SparkSession, root: str) -> int:
    """Remove all that the newest version does not use; returns the number of folders removed.

    Not while a refresh or a reader of an older version runs.
    """
    root = root.rstrip("/")
    state = _last(spark, root)
    used = {r["folder"] for r in state.slices.select("folder").distinct().collect()}
    used.add((state.version or "/").rsplit("/", 1)[1])
    old = [f for kind in ("versions", "partials", "cube", "incoming") for f in folders(spark, f"{root}/{kind}", complete=False)]
    return sum(remove_folder(spark, f) for f in old if f.rsplit("/", 1)[1] not in used)
