"""Higher timeframes without looking ahead, from rows as they come.

A candle of ratio w is w consecutive rows from the first one on (rows, not clock time). Each row sees the last
completed candle: high the highest, low the lowest, close the last of its rows. No join is needed: on a candle's last row the
frame of w rows is the candle, and later rows take the last such value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickwork.functions import schema as S
from wickwork.functions.timeframe import ratio

AGGREGATES = {"high": F.max, "low": F.min, "close": lambda c: c}


def columns(df: DataFrame, w: int, index: Column, inputs=("high", "low", "close")) -> tuple[dict[str, Column], dict[str, Column]]:
    """(completed candle on its last row, the same carried forward) by input: two layers of columns, the second over the first's names ``_done_{w}_{input}``."""
    order = S.in_order(df)
    frame = order.rowsBetween(1 - w, 0)
    last = index % w == w - 1
    done = {c: F.when(last, F.col(c) if c == "close" else AGGREGATES[c](c).over(frame)) for c in inputs}
    seen = {c: F.last(f"_done_{w}_{c}", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)) for c in inputs}
    return done, seen


def synthetic(df: DataFrame, timeframe: str, base: str) -> DataFrame:
    """df with high_, low_ and close_{timeframe}: what each row knows of the last completed candle."""
    w = ratio(timeframe, base)
    d = df.withColumn("_i", F.row_number().over(S.in_order(df)) - 1)
    done, seen = columns(d, w, F.col("_i"))
    d = d.withColumns({f"_done_{w}_{c}": e for c, e in done.items()}).withColumns({f"{c}_{timeframe}": e for c, e in seen.items()})
    return d.drop("_i", *(f"_done_{w}_{c}" for c in done))
