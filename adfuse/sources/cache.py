"""Tables that later calls find again, until an input file or a spec changes.

The key of an entry is the fingerprint of its inputs.  A miss builds the tables
in a folder of its own and then publishes a manifest that names them: whoever
finds a manifest finds whole tables, and a failed build leaves none.  If two
callers build the same entry at once, the first manifest counts.  A changed
input has another key, so the old entry is not found any more; ``evict``
removes such entries.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfuse.sources.files import fingerprint
from adfuse.sources.sinks import Stored
from adfuse.sources.storage import folders, remove_folder

_MANIFEST = "folder STRING, tables STRING, published TIMESTAMP"


class TableCache:
    """Cached tables below ``root``, a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _manifest(self, key: str) -> str:
        return f"{self.root}/manifests/{key}"

    def find(self, key: str) -> Mapping[str, Stored] | None:
        """The tables of an entry; none if it was not published."""
        at = self._manifest(key)
        if not any(f.endswith("/" + key) for f in folders(self.spark, f"{self.root}/manifests")):
            return None
        row = self.spark.read.schema(_MANIFEST).json(at).first()
        return {name: Stored(**{**t, "partition_by": tuple(t["partition_by"])}) for name, t in json.loads(row["tables"]).items()}

    def _publish(self, key: str, folder: str, tables: Mapping[str, Stored]) -> None:
        text = json.dumps({name: asdict(t) for name, t in tables.items()})
        row = self.spark.range(1).select(
            F.lit(folder).alias("folder"), F.lit(text).alias("tables"), F.current_timestamp().alias("published")
        )
        row.coalesce(1).write.json(self._manifest(key))

    def tables(
        self, inputs: Sequence[str], what: Sequence[str], build: Callable[[str], Mapping[str, Stored]]
    ) -> dict[str, DataFrame]:
        """The entry for the files below ``inputs`` and the texts ``what``.

        ``build`` gets a fresh folder, stores the tables there and returns
        them; it is called on a miss only.
        """
        key = fingerprint(self.spark, inputs, *what)
        found = self.find(key)
        if found is None:
            folder = f"{self.root}/data/{uuid.uuid4().hex}"
            try:
                found = build(folder)
                self._publish(key, folder, found)
            except AnalysisException:
                remove_folder(self.spark, folder)
                found = self.find(key)  # another caller was first
                if found is None:
                    raise
            except Exception:
                remove_folder(self.spark, folder)
                raise
        return {name: t.read(self.spark) for name, t in found.items()}

    def evict(self, keep: int = 1) -> int:
        """Remove all but the newest ``keep`` entries, and folders of broken-off builds; returns what is left.

        Not while somebody builds or still reads an old entry.
        """
        every = f"{self.root}/manifests"
        published = folders(self.spark, every)
        if published:
            rows = self.spark.read.schema(_MANIFEST).json(published).select("*", F.col("_metadata.file_path").alias("at"))
            newest = rows.orderBy(F.desc("published"), "folder").limit(keep).collect()
        else:
            newest = []
        kept = {r["at"].split("/")[-2] for r in newest}
        used = {r["folder"].rsplit("/", 1)[1] for r in newest}
        for f in folders(self.spark, every, complete=False):
            if f.rsplit("/", 1)[1] not in kept:
                remove_folder(self.spark, f)
        for f in folders(self.spark, f"{self.root}/data", complete=False):
            if f.rsplit("/", 1)[1] not in used:
                remove_folder(self.spark, f)
        return len(newest)
