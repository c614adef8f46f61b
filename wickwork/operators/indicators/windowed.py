"""Indicators as window expressions.

A builder gets a ``Layers`` object, which turns expressions into columns of a layer: all columns of a layer are computed
together, so indicators share one sort per layer and, having the same window, one exchange in all. Builders return the
final value; rows before the lookback are nulled by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


class Layers:
    """Columns to add, by layer, without repeats."""

    def __init__(self, window: WindowSpec):
        self.window = window
        self.layers: list[dict[str, Column]] = []
        self._known: dict[str, tuple[str, int]] = {}

    def add(self, layer: int, expression: Column) -> Column:
        text = f"{layer}:{expression}"
        if text not in self._known:
            while len(self.layers) <= layer:
                self.layers.append({})
            name = f"_ind_{layer}_{len(self.layers[layer])}"
            self.layers[layer][name] = expression
            self._known[text] = (name, layer)
        return F.col(self._known[text][0])

    def last(self, n: int) -> WindowSpec:
        """The frame of the last n rows."""
        return self.window.rowsBetween(1 - n, 0)

    def so_far(self) -> WindowSpec:
        from pyspark.sql import Window

        return self.window.rowsBetween(Window.unboundedPreceding, 0)


def _or0(value: Column, condition: Column) -> Column:
    return F.when(condition, value).otherwise(F.lit(0.0))


def ad(b: Layers, high, low, close, volume):
    flow = _or0(((close - low) - (high - close)) / (high - low) * volume, high > low)
    return b.add(1, F.sum(b.add(0, flow)).over(b.so_far()))


def aroon(b: Layers, high, low, *, timeperiod):
    w = b.last(timeperiod + 1)
    top = b.add(1, F.max_by(b.index, F.struct(high, b.index)).over(w))
    bottom = b.add(1, F.min_by(b.index, F.struct(low, -b.index)).over(w))
    share = lambda at: 100.0 * (timeperiod - (b.index - at)) / timeperiod
    return share(bottom), share(top)


def bbands(b: Layers, close, *, timeperiod, nbdevup, nbdevdn):
    w = b.last(timeperiod)
    mid, dev = b.add(1, F.avg(close).over(w)), b.add(1, F.stddev_pop(close).over(w))
    return mid + nbdevup * dev, mid, mid - nbdevdn * dev


def cci(b: Layers, high, low, close, *, timeperiod):
    w = b.last(timeperiod)
    price = b.add(0, (high + low + close) / 3.0)
    mean, seen = b.add(1, F.avg(price).over(w)), b.add(1, F.collect_list(price).over(w))
    off = F.aggregate(seen, F.lit(0.0), lambda s, x: s + F.abs(x - mean)) / timeperiod
    return _or0((price - mean) / (0.015 * off), (price != mean) & (off != 0))


def mfi(b: Layers, high, low, close, volume, *, timeperiod):
    w = b.last(timeperiod)
    price = b.add(0, (high + low + close) / 3.0)
    change = b.add(1, price - F.lag(price).over(b.window))
    flow = price * volume
    up = b.add(2, F.sum(F.when(change > 0, flow).otherwise(0.0)).over(w))
    down = b.add(2, F.sum(F.when(change < 0, flow).otherwise(0.0)).over(w))
    return _or0(100.0 * up / (up + down), up + down >= 1.0)


def mom(b: Layers, close, *, timeperiod):
    return close - b.add(1, F.lag(close, timeperiod).over(b.window))


def obv(b: Layers, close, volume):
    change = b.add(1, close - F.lag(close).over(b.window))
    signed = F.when(change.isNull(), volume).otherwise(F.signum(change) * volume)
    return b.add(2, F.sum(signed).over(b.so_far()))


def ppo(b: Layers, close, *, fastperiod, slowperiod):
    fast, slow = (b.add(1, F.avg(close).over(b.last(n))) for n in sorted((fastperiod, slowperiod)))
    return _or0(100.0 * (fast - slow) / slow, slow != 0)


def roc(b: Layers, close, *, timeperiod):
    before = b.add(1, F.lag(close, timeperiod).over(b.window))
    return F.when(before.isNull(), None).otherwise(_or0(100.0 * (close / before - 1), before != 0))


def _position(b: Layers, high, low, close, n):
    """(lowest low, highest high) of the last n rows."""
    return b.add(1, F.min(low).over(b.last(n))), b.add(1, F.max(high).over(b.last(n)))


def stoch(b: Layers, high, low, close, *, fastk_period, slowk_period, slowd_period):
    lowest, highest = _position(b, high, low, close, fastk_period)
    full = F.when(b.index >= fastk_period - 1, _or0(100.0 * (close - lowest) / (highest - lowest), highest != lowest))
    k = b.add(3, F.avg(b.add(2, full)).over(b.last(slowk_period)))
    k = F.when(b.index >= fastk_period + slowk_period - 2, k)
    return k, b.add(4, F.avg(k).over(b.last(slowd_period)))


def willr(b: Layers, high, low, close, *, timeperiod):
    lowest, highest = _position(b, high, low, close, timeperiod)
    return _or0(100.0 * (close - highest) / (highest - lowest), highest != lowest)


def wma(b: Layers, close, *, timeperiod):
    lags = [close, *(b.add(1, F.lag(close, k).over(b.window)) for k in range(1, timeperiod))]
    total = sum(((timeperiod - k) * x for k, x in enumerate(lags)), F.lit(0.0))
    return total / (timeperiod * (timeperiod + 1) / 2)
