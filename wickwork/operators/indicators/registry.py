"""The indicators: inputs, parameters, lookback, and how each is computed.

``windowed`` indicators are layers of column expressions over one window; ``kernel`` ones are recursions over a series.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from wickwork.operators.indicators import recursive as R
from wickwork.operators.indicators import windowed as W


@dataclass(frozen=True)
class Indicator:
    name: str
    inputs: tuple[str, ...]
    defaults: dict[str, int | float]
    lookback: Callable[..., int]
    fields: tuple[str, ...] = ()
    windowed: Callable | None = None
    kernel: Callable | None = None
    sizes: dict[str, int] = field(default_factory=dict)

    @property
    def template(self) -> str:
        return "_".join([self.name, *(f"{{{p}}}" for p in self.defaults)])


_HLC, _HLCV, _C = ("high", "low", "close"), ("high", "low", "close", "volume"), ("close",)


def _n(default: int) -> dict:
    return {"timeperiod": default}


#: Names, inputs, parameters with their defaults, lookbacks and fields.
_ALL = (
    Indicator("ad", _HLCV, {}, lambda: 0, windowed=W.ad),
    Indicator("adosc", _HLCV, {"fastperiod": 3, "slowperiod": 10}, lambda fastperiod, slowperiod: max(fastperiod, slowperiod) - 1, kernel=R.adosc),
    Indicator("adx", _HLC, _n(14), lambda timeperiod: 2 * timeperiod - 1, kernel=R.adx),
    Indicator("aroon", ("high", "low"), _n(14), lambda timeperiod: timeperiod, ("aroondown", "aroonup"), windowed=W.aroon),
    Indicator("atr", _HLC, _n(14), lambda timeperiod: timeperiod, kernel=R.atr),
    Indicator("bbands", _C, {"timeperiod": 20, "nbdevup": 2.0, "nbdevdn": 2.0}, lambda timeperiod, **_: timeperiod - 1, ("upperband", "middleband", "lowerband"), windowed=W.bbands),
    Indicator("cci", _HLC, _n(14), lambda timeperiod: timeperiod - 1, windowed=W.cci),
    Indicator("cmo", _C, _n(14), lambda timeperiod: timeperiod, kernel=R.cmo),
    Indicator("kama", _C, _n(30), lambda timeperiod: timeperiod, kernel=R.kama),
    Indicator("macd", _C, {"fastperiod": 12, "slowperiod": 26, "signalperiod": 9}, lambda fastperiod, slowperiod, signalperiod: max(fastperiod, slowperiod) + signalperiod - 2, ("macd", "macdsignal", "macdhist"), kernel=R.macd),
    Indicator("mfi", _HLCV, _n(14), lambda timeperiod: timeperiod, windowed=W.mfi),
    Indicator("mom", _C, _n(10), lambda timeperiod: timeperiod, windowed=W.mom),
    Indicator("obv", ("close", "volume"), {}, lambda: 0, windowed=W.obv),
    Indicator("ppo", _C, {"fastperiod": 12, "slowperiod": 26}, lambda fastperiod, slowperiod: max(fastperiod, slowperiod) - 1, windowed=W.ppo),
    Indicator("roc", _C, _n(10), lambda timeperiod: timeperiod, windowed=W.roc),
    Indicator("rsi", _C, _n(14), lambda timeperiod: timeperiod, kernel=R.rsi),
    Indicator("stoch", _HLC, {"fastk_period": 5, "slowk_period": 3, "slowd_period": 3}, lambda fastk_period, slowk_period, slowd_period: fastk_period + slowk_period + slowd_period - 3, ("slowk", "slowd"), windowed=W.stoch),
    Indicator("stochrsi", _C, {"timeperiod": 14, "fastk_period": 5, "fastd_period": 3}, lambda timeperiod, fastk_period, fastd_period: timeperiod + fastk_period + fastd_period - 2, ("fastk", "fastd"), kernel=R.stochrsi),
    Indicator("trix", _C, _n(30), lambda timeperiod: 3 * (timeperiod - 1) + 1, kernel=R.trix),
    Indicator("willr", _HLC, _n(14), lambda timeperiod: timeperiod - 1, windowed=W.willr),
    Indicator("wma", _C, _n(30), lambda timeperiod: timeperiod - 1, windowed=W.wma),
)
REGISTRY: dict[str, Indicator] = {i.name: i for i in _ALL}


def get(name: str) -> Indicator:
    if name not in REGISTRY:
        raise KeyError(f"unknown indicator {name!r}; known: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def validate_inputs(df: DataFrame, indicator: Indicator) -> None:
    missing = [c for c in indicator.inputs if c not in df.columns]
    if missing:
        raise ValueError(f"{indicator.name} needs columns that are missing: {', '.join(missing)}")
