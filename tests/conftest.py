from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from tidemark.session import configure

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.streaming.minBatchesToRetain", "2")
        .config("spark.checkpoint.dir", tmp_path_factory.mktemp("shared").as_uri())
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def tiny_slices(spark):
    """Make nearly every key hot, so that slicing is exercised on little data."""
    from tidemark.operators.ordered import MAX_ROWS_CONF

    spark.conf.set(MAX_ROWS_CONF, "3")
    yield
    spark.conf.unset(MAX_ROWS_CONF)
