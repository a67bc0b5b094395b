from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[*]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder (a cluster names a shared one)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="autolake-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="autolake-test-")


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
