"""What lies below input paths, as a table: for caches and refreshes that follow changed files.

Listing is Spark's own (in parallel beyond a few folders); no content is read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfuse.sources.spec import FeedSpec


def plain_path(uri: Column) -> Column:
    """The path that a file's URI (as in ``_metadata.file_path``) stands for."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def literal(path: str) -> str:
    """A path for a reader, with its pattern characters taken as they are."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def file_states(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(uri, path, length, modified) of every file below ``paths``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    uri = F.col("_metadata.file_path")
    return files.select(
        uri.alias("uri"), plain_path(uri).alias("path"), "length", F.col("modificationTime").alias("modified")
    )


def spec_text(spec: FeedSpec) -> str:
    """All that a spec says, the same text for equal specs."""
    return json.dumps(
        [spec.name, spec.platform, spec.date_format, *(sorted(m.items()) for m in (spec.source_types, spec.rename, spec.derived))]
    )


def fingerprint(spark: SparkSession, paths: Sequence[str], *what: str) -> str:
    """Names the state of all files below ``paths`` together with the texts ``what``.

    One aggregation over the listing; another order of the files does not matter.
    """
    states = file_states(spark, paths)
    each = [F.xxhash64("uri", "length", "modified", F.lit(k)) for k in range(2)]
    row = states.agg(F.count(F.lit(1)), F.sum("length"), *[F.bit_xor(h) for h in each]).first()
    return hashlib.sha256(json.dumps([list(row), list(what)]).encode()).hexdigest()[:32]
