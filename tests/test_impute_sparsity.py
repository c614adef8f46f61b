import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from wickwork.operators import impute, sparsity

START = datetime(2025, 1, 1)


def filled(df):
    return [(round((r["timestamp"] - START).total_seconds() / 60), r["close"], r["volume"], r["is_imputed"]) for r in impute.ffill(df, "5m").orderBy("timestamp").collect()]


def test_gaps_are_filled(candles):
    got = filled(candles([(0, 1.0), (5, 2.0), (20, 3.0)]))
    assert [(m, c, i) for m, c, _, i in got] == [(0, 1.0, False), (5, 2.0, False), (10, 2.0, True), (15, 2.0, True), (20, 3.0, False)]
    assert got[2][2] == 0.0


def test_off_grid_rows_vanish(candles):
    got = filled(candles([(0, 1.0), (5, 2.0), (7, 9.0), (10, 3.0)]))
    assert [c for _, c, _, _ in got] == [1.0, 2.0, 3.0] and not any(i for *_, i in got)


def test_observed_nulls_are_filled_but_not_counted(candles):
    df = candles([(0, 1.0), (5, None)]).selectExpr("symbol", "timeframe", "timestamp", "open", "high", "low", "close", "if(close is null, null, volume) volume")
    assert filled(df)[1] == (5, 1.0, 0.0, False)


def test_first_wins(candles):
    df = candles([(0, 1.0), (0, 2.0)]).selectExpr("*", "cast(close as long) as ingest_seq")
    assert [r["close"] for r in impute.ffill(df, "5m", "ingest_seq").collect()] == [1.0]


def test_long_series_come_in_runs(candles):
    got = impute.ffill(candles([(0, 1.0), (5 * 9999, 2.0)]), "5m")
    assert got.count() == 10_000 and got.where("is_imputed").count() == 9_998 and got.select("timestamp").distinct().count() == 10_000


def test_empty(candles):
    assert impute.ffill(candles(0), "5m").count() == 0


def test_count(candles):
    assert [tuple(r) for r in impute.imputed_count(impute.ffill(candles([(0, 1.0), (15, 2.0)]), "5m")).collect()] == [("aave-usdc", "5m", 2)]


def minutes(candles, ms):
    return candles([(m, 1.0) for m in ms], timeframe="1m")


def test_report(candles):
    r = sparsity.report(minutes(candles, [0, 1, 3, 3])).first()
    assert (r["actual"], r["expected"], r["missing"], r["availability"], r["sparsity"], r["gap_count"]) == (3, 4, 1, 0.75, 0.25, 1)
    assert (r["avg_gap_missing"], r["shortest_gap_missing"], r["largest_gap_missing"], r["avg_extra_gap_seconds"]) == (1.0, 1, 1, 60.0)
    assert (r["range_start"], r["range_end"], r["files_processed"]) == (START, START + timedelta(minutes=3), 1)


def test_floors(candles):
    r = sparsity.report(minutes(candles, [m for m in range(1000) if m != 500])).first()
    assert (r["actual"], r["expected"], r["availability"], r["sparsity"]) == (999, 1000, 0.99, 0.0)


def test_no_gaps(candles):
    r = sparsity.report(minutes(candles, [0, 1])).first()
    assert (r["gap_count"], r["avg_gap_missing"], r["shortest_gap_missing"]) == (0, 0.0, None)


def test_assets(candles):
    both = minutes(candles, [0]).union(candles([(0, 1.0)], symbol="btc-usd", timeframe="1m"))
    names = lambda a: sorted(r["asset"] for r in sparsity.report(both, a).collect())
    assert names([" BTC-usd ", ""]) == ["btc-usd"] and names([]) == ["aave-usdc", "btc-usd"]


def test_bad_names_and_text_timestamps(spark):
    df = spark.createDataFrame([("aave-usdc", "1m", "2025-01-01 00:00:00"), ("aave-usdc", "1m", "bad-ts"), ("AAVE-USDC", "1m", "2025-01-01 00:00:00"), ("aave-usdc", "1M", "2025-01-01 00:00:00")], "symbol string, timeframe string, timestamp string")
    assert [(r["asset"], r["actual"]) for r in sparsity.report(df).collect()] == [("aave-usdc", 1)]


def test_mixed_files(spark, candles, tmp_path):
    paths = [f"{tmp_path}/aave-usdc/1m/2025/{m:02}.parquet" for m in (1, 2, 3)]
    minutes(candles, [0, 1]).select("timestamp").coalesce(1).write.parquet(paths[0])
    spark.createDataFrame([("2025-01-01 00:02:00",), ("bad",)], "timestamp string").coalesce(1).write.parquet(paths[1])
    spark.createDataFrame([(1,)], "other int").write.parquet(paths[2])
    files = []
    for p in paths:
        files += [("aave-usdc", "1m", str(f)) for f in __import__("pathlib").Path(p).glob("*.parquet")]
    with pytest.warns(UserWarning):
        got = sparsity.read_timestamps(spark, files)
    r = sparsity.report(got, file="file").first()
    assert (r["actual"], r["files_processed"]) == (3, 2)


def month_file(spark, folder, rows, kind="timestamp_ntz"):
    """rows of (text) written as one Parquet file, timestamps as kind."""
    path = Path(folder)
    path.parent.mkdir(parents=True, exist_ok=True)
    spark.createDataFrame([(r,) for r in rows], "t string").selectExpr(f"cast(t as {kind}) as timestamp", "1 as close").coalesce(1).write.parquet(f"file://{path}.new")
    next(Path(f"{path}.new").glob("*.parquet")).rename(path)
    shutil.rmtree(f"{path}.new")


def test_assets_whose_files_have_equal_tails(spark, tmp_path):
    month_file(spark, tmp_path / "a b" / "aave-usdc/1m/2025/01.parquet", ["2025-01-01 00:00:00", "2025-01-01 00:01:00", "2025-01-01 00:02:00"])
    month_file(spark, tmp_path / "a b" / "btc-usdc/1m/2025/01.parquet", [f"2025-01-01 00:0{i}:00" for i in range(5)])
    month_file(spark, tmp_path / "a b" / "eth-usdc/1m/2025/01.parquet", [f"2025-01-01 00:0{i}:00" for i in range(4)], "string")
    got = {r["asset"]: (r["actual"], r["files_processed"]) for r in sparsity.report_path(spark, str(tmp_path / "a b")).collect()}
    assert got == {"aave-usdc": (3, 1), "btc-usdc": (5, 1), "eth-usdc": (4, 1)}


def test_a_folder_with_odd_names(spark, tmp_path):
    for name in ("aave-usdc/1m/2025/01", "aave-usdc/1m/2025/1", "aave-usdc/1m/25/01", "aave-usdc/1M/2025/01", "AAVE-USDC/1m/2025/01"):
        month_file(spark, tmp_path / f"{name}.parquet", ["2025-01-01 00:00:00"])
    month_file(spark, tmp_path / "aave-usdc/1m/2025/02.parquet", ["bad-ts", "2025-01-01T00:01:00Z"], "string")
    (tmp_path / "aave-usdc/1m/2025/03.parquet").write_bytes(b"no Parquet")
    with pytest.warns(UserWarning) as seen:
        got = sparsity.report_path(spark, f"file://{tmp_path}", ["AAVE-usdc", "gone-usdc"]).collect()
    said = " ".join(str(w.message) for w in seen)
    assert all(x in said for x in ("'AAVE-USDC'", "'1M'", "'25'", "'1.parquet'", "'gone-usdc'", "03.parquet"))
    assert [(r["asset"], r["actual"], r["missing"], r["files_processed"]) for r in got] == [("aave-usdc", 2, 0, 2)]


def test_nothing_there(spark, tmp_path):
    with pytest.warns(UserWarning):
        none = sparsity.report_path(spark, str(tmp_path / "no"))
    assert none.count() == 0 and none.columns[:2] == ["asset", "timeframe"]


def test_files_that_alternate_count_once(spark):
    rows = [("a-b", "1m", f"2025-01-01 00:{i:02}:00", f"f{i % 2}") for i in range(20)] + [("a-b", "1m", "2025-01-01 00:03:00", "f7")]
    df = spark.createDataFrame(rows, "symbol string, timeframe string, timestamp string, file string")
    assert sparsity.report(df, file="file").first()["files_processed"] == 3


def test_a_zone_with_summer_time(spark, candles):
    rows = candles([(60 * h, float(h)) for h in (0, 1, 5, 6)], start=datetime(2024, 3, 10), timeframe="1h")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = impute.ffill(rows, "1h").collect()
        millis = sorted(r["timestamp"] for r in impute.as_epoch_millis(impute.ffill(rows, "1h")).collect())
        r = sparsity.report(rows).first()
        late = spark.createDataFrame([("a-b", "1h", "2024-03-10 02:30:00"), ("a-b", "1h", "2024-03-10T03:30:00Z")], "symbol string, timeframe string, timestamp string")
        text = sparsity.report(late).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted((r["timestamp"].hour, r["close"], r["is_imputed"]) for r in got) == [(0, 0.0, False), (1, 1.0, False), (2, 1.0, True), (3, 1.0, True), (4, 1.0, True), (5, 5.0, False), (6, 6.0, False)]
    assert millis[0] == 1710028800000 and (r["actual"], r["expected"], r["range_end"]) == (4, 7, datetime(2024, 3, 10, 6))
    assert (text["range_start"], text["range_end"], text["expected"]) == (datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 10, 3, 30), 2)


def test_first_without_an_order_is_the_same_each_time(candles):
    df = candles([(0, 3.0), (0, 1.0), (0, 2.0)])
    assert [r["close"] for r in impute.ffill(df, "5m").collect()] == [1.0] == [r["close"] for r in impute.ffill(df.orderBy("close", ascending=False), "5m").collect()]
    both = df.selectExpr("*", "cast(4 - close as long) as ingest_seq")
    assert [r["close"] for r in impute.ffill(both, "5m").collect()] == [3.0]
