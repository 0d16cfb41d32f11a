"""Shared scratch location for lineage cuts and intermediate tables.

Intermediate data must live on storage every executor can reach, never on a
machine-local temp folder.  The cluster names that folder in
``spark.checkpoint.dir``; we only pick our own when it is unset (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; set one only if none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context, the server owns the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder shared by all executors "
                "(a machine-local temp folder would not survive executor loss)"
            )
        # Local mode (tests, single-machine runs) only.
        configured = tempfile.mkdtemp(prefix="adfuse-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused directory under the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/adfuse-{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_scratch(spark: SparkSession, path: str) -> bool:
    """Remove a folder made by ``scratch_path``, on whatever file system it is.

    For the caller of a result that reads it, once that result is consumed.
    Anything that is not a scratch folder is refused.
    """
    if not path.startswith(f"{checkpoint_root(spark).rstrip('/')}/adfuse-"):
        raise ValueError(f"{path} is not a scratch folder")
    fs, p = _hadoop_path(spark, path)
    return fs.delete(p, True)


def folders(spark: SparkSession, path: str, complete: bool = True) -> list[str]:
    """Sub-folders of ``path``, by name; only finished writes if ``complete``."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(str(f) for f in found if not complete or fs.exists(mark(f, "_SUCCESS")))


def remove_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.delete(p, True)
