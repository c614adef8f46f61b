import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def candles(spark):
    """candles(rows, step): rows of (minute, close) or n rising candles, as one series."""

    def make(rows, step=5, start=datetime(2025, 1, 1), symbol="aave-usdc", timeframe="5m"):  # noqa: DTZ001
        if isinstance(rows, int):
            rows = [(i * step, 100.5 + i) for i in range(rows)]
        data = [
            (symbol, timeframe, start + timedelta(minutes=m), None if c is None else c - 0.5, None if c is None else c + 0.5, None if c is None else c - 1.5, c, 1000.0 + m)
            for m, c in rows
        ]
        return spark.createDataFrame(data, "symbol string, timeframe string, timestamp timestamp_ntz, open double, high double, low double, close double, volume double")

    return make
