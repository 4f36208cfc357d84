from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallytide.scale import BROADCAST_BYTES, TASK_ROWS  # noqa: E402
from tallytide.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def small_tasks(spark):
    """Lower the task bound so that every series is cut; use as ``small_tasks(rows)``."""

    def lower(rows: int, broadcast_bytes: int | None = None) -> None:
        spark.conf.set(TASK_ROWS, str(rows))
        if broadcast_bytes is not None:
            spark.conf.set(BROADCAST_BYTES, str(broadcast_bytes))

    yield lower
    spark.conf.unset(TASK_ROWS)
    spark.conf.unset(BROADCAST_BYTES)


@pytest.fixture(params=["whole", "split"])
def layout_mode(request, small_tasks):
    """Run a test once with whole series and once with series cut into small chunks."""
    if request.param == "split":
        small_tasks(3)
    return request.param
