import random

import pytest
from pyspark.sql import functions as F

from wickwork.operators.indicators import REGISTRY, add_indicator, add_indicators, get, output_name
from wickwork.operators.indicators import recursive as R
from wickwork.operators.indicators.synthetic import synthetic


def values(df, column):
    return [r[0] for r in df.orderBy("timestamp").select(column).collect()]


@pytest.fixture()
def walk(candles):
    r, c, rows = random.Random(5), 100.0, []
    for i in range(120):
        c += r.choice((-2, -1, 1, 2, 3, -3)) * 0.5
        rows.append((5 * i, c))
    return candles(rows)


@pytest.mark.parametrize(("name", "tf", "params", "want"), [("adx", "5m", {}, "adx_14_5m"), ("macd", "1h", {}, "macd_12_26_9_1h"), ("bbands", "15m", {}, "bbands_20_2_0_2_0_15m"), ("obv", "5m", {}, "obv_5m")])
def test_names(name, tf, params, want):
    assert output_name(get(name), params, tf) == want


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_lookback_and_rows(walk, name):
    i = get(name)
    d = add_indicator(walk, name, "5m", "5m")
    column = output_name(i, {}, "5m")
    got = values(d, f"{column}.{i.fields[-1]}" if i.fields else column)
    assert len(got) == 120
    assert [x is None for x in got] == [k < i.lookback(**i.defaults) for k in range(120)]


def test_all_at_once_and_shuffled_input(walk):
    specs = [(n, "5m", {}) for n in REGISTRY]
    a = add_indicators(walk, specs, "5m")
    b = add_indicators(walk.orderBy(F.rand(3)), specs, "5m")
    assert a.collect() == b.collect()
    assert a.columns[:8] == walk.columns


def test_no_look_ahead(walk):
    specs = [(n, "5m", {}) for n in REGISTRY] + [("rsi", "15m", {"timeperiod": 5}), ("stoch", "30m", {})]
    whole = add_indicators(walk, specs, "5m").collect()
    part = add_indicators(walk.orderBy("timestamp").limit(90), specs, "5m").collect()
    assert whole[:90] == part


def test_series_are_apart(walk):
    other = walk.withColumn("symbol", F.lit("btc-usd")).withColumn("close", F.col("close") * 2)
    both = add_indicators(walk.union(other), [("rsi", "5m", {}), ("mom", "5m", {})], "5m")
    one = add_indicators(walk, [("rsi", "5m", {}), ("mom", "5m", {})], "5m")
    assert both.where("symbol = 'aave-usdc'").orderBy("timestamp").collect() == one.collect()


def test_one_series_without_keys(walk):
    d = add_indicators(walk.drop("symbol", "timeframe"), [("rsi", "5m", {}), ("mom", "5m", {})], "5m")
    assert d.columns == ["timestamp", "open", "high", "low", "close", "volume", "rsi_14_5m", "mom_10_5m"]


def test_structs(walk):
    d = add_indicator(walk, "bbands", "5m", "5m", timeperiod=5)
    assert d.schema["bbands_5_2_0_2_0_5m"].dataType.names == ["upperband", "middleband", "lowerband"]


def test_synthetic(candles):
    d = candles([(5 * i, float(i + 1)) for i in range(7)])
    assert values(synthetic(d, "15m", "5m"), "close_15m") == [None, None, 3.0, 3.0, 3.0, 6.0, 6.0]


def test_synthetic_differs_and_keeps_callers_columns(walk):
    d = add_indicators(walk.withColumn("high_15m", F.lit(1.0)), [("rsi", "5m", {"timeperiod": 3}), ("rsi", "15m", {"timeperiod": 3})], "5m")
    assert values(d, "rsi_3_5m")[20:] != values(d, "rsi_3_15m")[20:]
    assert set(values(d, "high_15m")) == {1.0}
    assert values(d, "rsi_3_15m").index(next(x for x in values(d, "rsi_3_15m") if x is not None)) == 5


def test_replaces_a_column_of_its_name(walk):
    once = add_indicator(walk, "mom", "5m", "5m")
    assert add_indicator(once, "mom", "5m", "5m").collect() == once.collect()


def test_errors(walk):
    with pytest.raises(KeyError, match="known"):
        add_indicator(walk, "nope", "5m", "5m")
    with pytest.raises(ValueError, match="low, close"):
        add_indicator(walk.drop("low", "close"), "adx", "5m", "5m")
    with pytest.raises(ValueError, match="timestamp"):
        add_indicator(walk.drop("timestamp"), "mom", "5m", "5m")
    with pytest.raises(ValueError):
        add_indicator(walk, "mom", "1m", "5m")
    with pytest.raises(ValueError, match="volume"):
        add_indicator(walk, "obv", "15m", "5m")
    with pytest.raises(ValueError, match="no parameters"):
        add_indicator(walk, "ppo", "5m", "5m", timeperiod=3)


def test_hand_values():
    c = [1.0, 2.0, 3.0, 2.0, 4.0]
    assert R.rsi(c, timeperiod=2)[0] == [None, None, 100.0, 50.0, pytest.approx(100 * 1.25 / 1.5)]
    assert R.cmo(c, timeperiod=2)[0][3] == 0.0
    assert R.ema(c, 3) == [None, None, 2.0, 2.0, 3.0]
    assert R.kama([1.0, 2.0, 4.0], timeperiod=2)[0][2] == pytest.approx(2 + 2 * (2 / 3) ** 2)
    flat = [5.0] * 40
    assert R.rsi(flat, timeperiod=14)[0][-1] == 0.0
    assert R.adx(flat, flat, flat, timeperiod=5)[0][-1] == 0.0
    assert R.stochrsi(flat, timeperiod=14, fastk_period=5, fastd_period=3)[0][-1] == 0.0
    assert R.atr([3.0, 4.0, 6.0], [1.0, 2.0, 3.0], [2.0, 3.0, 5.0], timeperiod=2)[0] == [None, None, 2.5]


def test_too_short_for_any_value(candles):
    d = add_indicators(candles(3), [(n, "5m", {}) for n in REGISTRY if n not in ("ad", "obv")], "5m")
    assert all(v is None for r in d.collect() for v in r[8:])
    empty = add_indicators(candles(0), [("rsi", "5m", {}), ("cci", "5m", {})], "5m")
    assert empty.count() == 0


RECURSIVE = sorted(n for n, i in REGISTRY.items() if i.kernel)


@pytest.mark.parametrize("name", RECURSIVE)
def test_nulls_are_stepped_over(walk, name):
    """Rows without prices, at the start and inside, have no value; the others have what they would have without those rows."""
    rows = walk.orderBy("timestamp").collect()
    holes = {*range(6), 30, 31, 77, 119}
    holed = walk.sparkSession.createDataFrame([(*r[:3], *((None,) * 5 if k in holes else r[3:8])) for k, r in enumerate(rows)], walk.schema)
    without = walk.sparkSession.createDataFrame([r for k, r in enumerate(rows) if k not in holes], walk.schema)
    column = output_name(get(name), {}, "5m")
    got = {r["timestamp"]: r[column] for r in add_indicator(holed, name, "5m", "5m").collect()}
    want = {r["timestamp"]: r[column] for r in add_indicator(without, name, "5m", "5m").collect()}
    assert got == {r["timestamp"]: want.get(r["timestamp"]) for r in rows} and any(v is not None for v in got.values())


@pytest.mark.parametrize("name", RECURSIVE)
def test_no_prices_at_all(candles, name):
    got = add_indicators(candles([(5 * i, None) for i in range(70)]), [(name, "5m", {})], "5m")
    assert [r[-1] for r in got.collect()] == [None] * 70


def test_one_missing_input_is_enough(walk):
    holed = walk.withColumn("high", F.when(F.minute("timestamp") != 5, F.col("high")))
    got = values(add_indicator(holed, "atr", "5m", "5m", timeperiod=3), "atr_3_5m")
    assert [k for k, v in enumerate(got) if v is None and k > 4] == [k for k in range(5, 120) if k % 12 == 1]


def test_scans_are_recursions():
    r = random.Random(3)
    for n in (0, 1, 2, 7, 500):
        b, y, d = [r.random() for _ in range(n)], [], 0.93
        for x in b:
            y.append(d * y[-1] + x if y else x)
        assert R.decayed(b, d).tolist() == pytest.approx(y) and R.decayed(b, d)[: n // 2].tolist() == R.decayed(b[: n // 2], d).tolist()
