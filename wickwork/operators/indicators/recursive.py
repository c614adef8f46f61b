"""Recursive indicators over one series.

A kernel takes columns of numbers without nulls and the parameters, and returns one list per output field; None
stands where there is no value yet. Formulas are those of the public TA-Lib definitions. NaN goes on as arithmetic has it.

Recursions of the first order, y[i] = d y[i - 1] + b[i], are scans: in pass s each value takes in what lies s rows before it, s doubling.
A value depends on the rows up to its own alone, to the last bit, however long the series is.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

Series = Sequence[float] | np.ndarray
Out = list[float | None]


def _array(x: Series) -> np.ndarray:
    return np.asarray(x, float)


def _late(skip: int, values: np.ndarray, length: int) -> Out:
    """values from row skip on, as a list of the length."""
    return [None] * min(skip, length) + values[: max(0, length - skip)].tolist()


def decayed(b: np.ndarray, d: float) -> np.ndarray:
    """y with y[0] = b[0] and y[i] = d y[i - 1] + b[i]."""
    y, s = np.array(b, float), 1
    while s < len(y) and d > 0:
        y[s:] = y[s:] + d * y[:-s]
        s, d = 2 * s, d * d
    return y


def ema(x: Series, n: int, first: int = 0) -> Out:
    """Exponential mean with factor 2 / (n + 1), seeded by the mean of rows first to first + n - 1."""
    return _late(first + n - 1, _ema(_array(x), n, first), len(x))


def _ema(x: np.ndarray, n: int, first: int = 0) -> np.ndarray:
    at, k = first + n - 1, 2.0 / (n + 1)
    if at >= len(x):
        return np.zeros(0)
    b = k * x[at:]
    b[0] = sum(x[first : first + n].tolist()) / n
    return decayed(b, 1 - k)


def adosc(high: Series, low: Series, close: Series, volume: Series, *, fastperiod: int, slowperiod: int) -> tuple[Out]:
    h, lo, c, v = map(_array, (high, low, close, volume))
    spread = h > lo
    total = np.cumsum(np.where(spread, ((c - lo) - (h - c)) / np.where(spread, h - lo, 1.0) * v, 0.0))
    means = []
    for n in (fastperiod, slowperiod):
        k = 2.0 / (n + 1)
        b = k * total
        b[:1] = total[:1]
        means.append(decayed(b, 1 - k))
    skip = max(fastperiod, slowperiod) - 1
    return (_late(skip, (means[0] - means[1])[skip:], len(c)),)


def _true_range(high: np.ndarray, low: np.ndarray, close: np.ndarray) -> np.ndarray:
    """From row 1 on."""
    return np.maximum(high[1:] - low[1:], np.maximum(np.abs(high[1:] - close[:-1]), np.abs(low[1:] - close[:-1])))


def _wilder_sum(x: np.ndarray, n: int) -> np.ndarray:
    """The sum of the first n - 1 values, and from there on nth parts lost and values won."""
    return decayed(np.concatenate([[sum(x[: n - 1].tolist())], x[n - 1 :]]), (n - 1) / n)[1:]


def adx(high: Series, low: Series, close: Series, *, timeperiod: int) -> tuple[Out]:
    n, length = timeperiod, len(close)
    if length < 2 * n:
        return ([None] * length,)
    h, lo, c = map(_array, (high, low, close))
    up, down = h[1:] - h[:-1], lo[:-1] - lo[1:]
    plus = _wilder_sum(np.where((up > 0) & (up > down), up, 0.0), n)
    minus = _wilder_sum(np.where((down > 0) & (up < down), down, 0.0), n)
    rng = _wilder_sum(_true_range(h, lo, c), n)
    moved = rng != 0
    dp, dm = (100.0 * x / np.where(moved, rng, 1.0) for x in (plus, minus))
    valid = moved & (dp + dm != 0)
    dx = np.where(valid, 100.0 * np.abs(dm - dp) / np.where(valid, dp + dm, 1.0), 0.0)
    later = valid[n:]
    steps = decayed(np.concatenate([[sum(dx[:n].tolist()) / n], dx[n:][later] / n]), (n - 1) / n)
    return (_late(2 * n - 1, steps[np.concatenate([[0], np.cumsum(later)])], length),)


def atr(high: Series, low: Series, close: Series, *, timeperiod: int) -> tuple[Out]:
    n, tr = timeperiod, _true_range(*map(_array, (high, low, close)))
    if len(tr) < n:
        return ([None] * len(close),)
    return (_late(n, _wilder_mean(tr, n), len(close)),)


def _wilder_mean(x: np.ndarray, n: int) -> np.ndarray:
    """The mean of the first n values, and from there on Wilder's mean."""
    return decayed(np.concatenate([[sum(x[:n].tolist()) / n], x[n:] / n]), (n - 1) / n)


def _gains(close: Series, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean gain, mean loss) from row n on."""
    x = _array(close)
    if len(x) <= n:
        return np.zeros(0), np.zeros(0)
    change = np.diff(x)
    return _wilder_mean(np.maximum(change, 0.0), n), _wilder_mean(np.maximum(-change, 0.0), n)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.where(whole != 0, 100.0 * part / np.where(whole != 0, whole, 1.0), 0.0)


def cmo(close: Series, *, timeperiod: int) -> tuple[Out]:
    g, x = _gains(close, timeperiod)
    return (_late(timeperiod, _share(g - x, g + x), len(close)),)


def rsi(close: Series, *, timeperiod: int) -> tuple[Out]:
    g, x = _gains(close, timeperiod)
    return (_late(timeperiod, _share(g, g + x), len(close)),)


def kama(close: Series, *, timeperiod: int) -> tuple[Out]:
    n, out = timeperiod, [None] * len(close)
    close = _array(close).tolist()
    if len(close) <= n:
        return (out,)
    slowest, spread = 2.0 / 31.0, 2.0 / 3.0 - 2.0 / 31.0
    walk = sum(abs(close[i] - close[i - 1]) for i in range(1, n + 1))
    value = close[n - 1]
    for i in range(n, len(close)):
        if i > n:
            walk += abs(close[i] - close[i - 1]) - abs(close[i - n] - close[i - n - 1])
        way = close[i] - close[i - n]
        efficiency = 1.0 if walk <= way or abs(walk) < 1e-14 else abs(way / walk)
        value += (close[i] - value) * (efficiency * spread + slowest) ** 2
        out[i] = value
    return (out,)


def macd(close: Series, *, fastperiod: int, slowperiod: int, signalperiod: int) -> tuple[Out, Out, Out]:
    fast, slow = sorted((fastperiod, slowperiod))
    x = _array(close)
    line = _ema(x, fast, slow - fast) - _ema(x, slow)
    signal = _ema(line, signalperiod)
    line, skip = line[signalperiod - 1 :], slow + signalperiod - 2
    return _late(skip, line, len(x)), _late(skip, signal, len(x)), _late(skip, line - signal, len(x))


def stochrsi(close: Series, *, timeperiod: int, fastk_period: int, fastd_period: int) -> tuple[Out, Out]:
    n, length, skip = timeperiod, len(close), timeperiod + fastk_period + fastd_period - 2
    if length <= skip:
        return [None] * length, [None] * length
    # step by step: while prices rest the index does, too, and a last bit of difference would be a range of its own
    change = np.diff(_array(close)).tolist()
    gain, loss = sum(max(c, 0.0) for c in change[:n]) / n, sum(max(-c, 0.0) for c in change[:n]) / n
    means = [(gain, loss)]
    for c in change[n:]:
        gain, loss = (gain * (n - 1) + max(c, 0.0)) / n, (loss * (n - 1) + max(-c, 0.0)) / n
        means.append((gain, loss))
    g, x = np.array(means).T
    r = _share(g, g + x)
    seen = np.lib.stride_tricks.sliding_window_view(r, fastk_period)
    lo, hi = seen.min(axis=1), seen.max(axis=1)
    k = _share(r[fastk_period - 1 :] - lo, hi - lo)
    d = sum(k[j : len(k) - fastd_period + 1 + j] for j in range(fastd_period)) / fastd_period
    return _late(skip, k[fastd_period - 1 :], length), _late(skip, d, length)


def trix(close: Series, *, timeperiod: int) -> tuple[Out]:
    x, length = _array(close), len(close)
    for _ in range(3):
        x = _ema(x, timeperiod)
    if not len(x):
        return ([None] * length,)
    before = x[:-1]
    change = np.where(before != 0, 100.0 * (x[1:] / np.where(before != 0, before, 1.0) - 1), 0.0)
    return (_late(3 * (timeperiod - 1) + 1, change, length),)
