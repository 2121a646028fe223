from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.session import checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("marquee-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="marquee-test-wh-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # the session's own setting, or a test folder when unset
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_catalog(spark):
    from marquee.sources import load_testdata

    return load_testdata(spark, SF_SMALL)
