import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package too, wherever pytest was started.
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Golden values of the original exports, which are not in this repository; the same
# path over hand-written exports is in test_feeds.py.
collect_ignore = [] if os.environ.get("ADFUSE_CSV_DIR") else ["test_golden.py"]

SF_SMALL = os.environ.get("ADFUSE_TEST_SF", "/root/testdata/sf0.001")
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("adfuse-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: use the configured shared folder, or a fresh local one if unset.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="adfuse-test-ckpt-"))
    yield s
    s.stop()
