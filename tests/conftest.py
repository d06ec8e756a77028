import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[4]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests only: pick a scratch checkpoint folder when the session names none
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="patchprofile-test-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def rows(df, order=None):
    """Collected rows as sorted tuples (None-safe)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))
