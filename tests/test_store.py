from datetime import datetime

import pytest

from wickwork.sources import store
from wickwork.streaming.upsert import write_stream


@pytest.fixture()
def folder(tmp_path):
    return f"file://{tmp_path}/store"


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_bounds(spark, candles, folder):
    store.save(candles([(0, 1.0), (5, 2.0), (10, 3.0), (15, 4.0)]), folder, "AAVE/USDC", "5m")
    load = lambda **k: store.load_range(spark, folder, "aave-usdc", "5m", **k)
    assert load(start="2025-01-01T00:10:00Z").count() == 2
    assert load(end="2025-01-01T00:10:00Z").count() == 3
    assert rows(load(start="2025-01-01T00:05:00", end="2025-01-01T00:10:00"), "close") == [(2.0,), (3.0,)]


def test_month_edge(spark, candles, folder):
    store.save(candles([(-5, 1.0), (0, 2.0), (5, 3.0)], start=datetime(2025, 2, 1)), folder)
    got = store.load_range(spark, folder, "AAVE-USDC", "5m", "2025-01-31T23:58:00", "2025-02-01T00:01:00")
    assert rows(got, "timestamp") == [(datetime(2025, 2, 1),)]


def test_empty(spark, candles, folder):
    store.save(candles(0), folder)
    got = store.load_range(spark, folder, "x", "1h")
    assert got.count() == 0 and got.columns == ["symbol", "timeframe", "timestamp", "open", "high", "low", "close", "volume"]
    with pytest.raises(ValueError):
        store.load_range(spark, folder, "x", "7m")


def test_keep_last_and_idempotence(spark, candles, folder):
    store.save(candles([(0, 1.0)]), folder)
    for _ in range(2):
        store.save(candles([(0, 99.0)]), folder)
    assert rows(store.load(spark, folder, "aave-usdc", "5m"), "close") == [(99.0,)]


def test_first_write_dedupes(spark, candles, folder):
    two = candles([(0, 1.0), (0, 2.0)]).coalesce(1)
    store.save(two, folder)
    assert rows(store.load(spark, folder, "aave-usdc", "5m"), "close") == [(2.0,)]


def test_load_filters(spark, candles, folder):
    for month in (datetime(2025, 1, 1), datetime(2025, 2, 1), datetime(2026, 1, 1)):
        store.save(candles([(0, 1.0)], start=month), folder)
    count = lambda *a: store.load(spark, folder, "aave-usdc", "5m", *a).count()
    assert (count(), count(2025), count(2025, 1)) == (3, 2, 1)
    with pytest.raises(ValueError):
        count(None, 1)
    with pytest.raises(ValueError):
        count(2025, 13)


def test_wrong_month_is_purged(spark, candles, folder):
    store.save(candles([(0, 1.0)], start=datetime(2025, 2, 1)), folder)
    stray = store.stored(spark, folder).selectExpr("timestamp - interval 20 days as timestamp", "open", "high", "low", "close", "volume", "ingest_seq")
    stray.write.mode("append").parquet(f"{folder}/symbol=aave-usdc/timeframe=5m/year=2025/month=2")
    store.save(candles([(5, 2.0)], start=datetime(2025, 2, 1)), folder)
    assert rows(store.load(spark, folder, "aave-usdc", "5m"), "close") == [(1.0,), (2.0,)]


def test_other_series_stay(spark, candles, folder):
    store.save(candles([(0, 1.0)]), folder)
    store.save(candles([(0, 5.0)], symbol="BTC/USD"), folder)
    assert store.stored(spark, folder).count() == 2


def test_missing_columns(candles, folder):
    with pytest.raises(ValueError, match="volume"):
        store.save(candles(3).drop("volume"), folder)


def test_range_is_pruned(spark, candles, folder):
    store.save(candles([(0, 1.0)]), folder)
    plan = store.load_range(spark, folder, "aave-usdc", "5m", "2025-01-01T00:00:00")._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "year" in scan.split("PartitionFilters")[1].split("PushedFilters")[0] and "timestamp" in scan.split("PushedFilters")[1]


def test_newest_excludes(candles):
    c = candles(10)
    got = store.newest(c, 3, c.where("close > 108"))
    assert sorted(r[0] for r in got.select("close").collect()) == [105.5, 106.5, 107.5]


def test_update_corrects_the_open_candle(spark, candles, folder):
    store.save(candles([(0, 1.0), (5, 2.0)]), folder)
    got = store.update(spark, folder, "aave-usdc", "5m", candles([(5, 2.5), (10, 3.0)]))
    assert rows(got, "close") == [(1.0,), (2.5,), (3.0,)]


def test_stream_upserts(spark, candles, folder, tmp_path):
    source = f"{tmp_path}/in"
    candles([(0, 1.0), (5, 2.0)]).write.parquet(source)
    stream = spark.readStream.schema(candles(1).schema).parquet(source)
    write_stream(stream, folder, f"{tmp_path}/check").awaitTermination(60)
    assert store.load(spark, folder, "aave-usdc", "5m").count() == 2


def test_a_save_reads_only_the_months_it_writes(spark, candles, tmp_path):
    folder = f"file://{tmp_path}/s"
    store.save(candles([(60 * 24 * d, 1.0) for d in range(200)]), folder)
    new = candles([(60 * 24 * 100, 2.0)]).selectExpr("*", "year(timestamp) AS year", "month(timestamp) AS month").where("close > 0")
    old = store.touched(store.stored(spark, folder), new)
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and plan.count("PartitionFilters: [isnotnull") + plan.count("dynamicpruning") >= 2
    assert {(r["year"], r["month"]) for r in old.select("year", "month").collect()} == {(2025, 4)}
