from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tunestats.session import apply_scale_conf

    s = (SparkSession.builder.master("local[*]")
         .appName("tunestats-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tunestats-wh-"))
         # tests set their own shared folder
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tunestats-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_scale_conf(s)
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="tunestats-test-")


def rows(df, *cols):
    """Collected rows as sorted tuples (NULLs first)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is not None, str(v)) for v in t))
