"""Indicator requests, compiled together.

All requests share one window per series: a layer of row numbers and completed candles, then the indicators' own layers
side by side, then one pass of kernels over Arrow tables for all recursive indicators at once. A thousand requests are a few
window operators on one exchange, not a thousand plans. A series is the unit of parallelism.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickwork.functions import schema as S
from wickwork.functions.timeframe import ratio, seconds
from wickwork.operators.indicators import synthetic
from wickwork.operators.indicators.registry import Indicator, get, validate_inputs
from wickwork.operators.indicators.windowed import Layers

Spec = tuple[str, str, dict]


def output_name(indicator: Indicator, params: dict, timeframe: str) -> str:
    values = indicator.defaults | params
    name = "_".join([indicator.name, *(str(values[p]).replace(".", "_") for p in indicator.defaults)])
    return f"{name}_{timeframe}"


def _resolve(df: DataFrame, name: str, timeframe: str, base: str, params: dict) -> tuple[Indicator, dict, int]:
    S.need(df, ("timestamp",))
    indicator = get(name)
    validate_inputs(df, indicator)
    unknown = sorted(set(params) - set(indicator.defaults))
    if unknown:
        raise ValueError(f"{name} has no parameters {', '.join(unknown)}")
    seconds(timeframe)
    if timeframe == base:
        return indicator, indicator.defaults | params, 1
    if seconds(timeframe) < seconds(base):
        raise ValueError(f"{timeframe} is shorter than the base timeframe {base}")
    if "volume" in indicator.inputs:
        raise ValueError(f"{name} needs volume, which a longer timeframe does not have")
    return indicator, indicator.defaults | params, ratio(timeframe, base)


def add_indicator(df: DataFrame, name: str, timeframe: str, base_timeframe: str, **params) -> DataFrame:
    """df, ascending in time, with the indicator's column; several fields make a struct. A column of that name is replaced."""
    return add_indicators(df, [(name, timeframe, params)], base_timeframe)


def add_indicators(df: DataFrame, specs: list[Spec], base_timeframe: str, ordered: bool = True) -> DataFrame:
    """df with a column for each (name, timeframe, params). Values before the lookback are null; rows and their number stay as they are."""
    todo = {}
    for name, timeframe, params in specs:
        indicator, values, w = _resolve(df, name, timeframe, base_timeframe, params)
        todo[output_name(indicator, params, timeframe)] = (indicator, values, w)
    order = S.in_order(df)
    kept = [c for c in df.columns if c not in todo]
    d = df.select(*(F.col(f"`{c}`") for c in kept)).withColumn("_i", F.row_number().over(order) - 1)
    needed = sorted({(w, c) for i, _, w in todo.values() for c in i.inputs})
    higher = sorted({w for w, _ in needed if w > 1})
    done, seen, inputs = {}, {}, {(1, c): F.col(c) for _, c in needed}
    for w in higher:
        wanted = [c for x, c in needed if x == w]
        a, b = synthetic.columns(d, w, F.col("_i"), wanted)
        done |= {f"_done_{w}_{c}": e for c, e in a.items()}
        seen |= {f"_seen_{w}_{c}": e for c, e in b.items()}
        inputs |= {(w, c): F.col(f"_seen_{w}_{c}") for c in wanted}
    if higher:
        d = d.withColumns(done).withColumns(seen).drop(*done)

    layers, out = Layers(order), {}
    for name, (indicator, values, w) in todo.items():
        if indicator.windowed is None:
            continue
        columns = [inputs[w, c] for c in indicator.inputs]
        layers.index = F.col("_i") - (w - 1)
        found = indicator.windowed(layers, *columns, **values)
        ready = F.col("_i") >= indicator.lookback(**values) + w - 1
        if indicator.fields:
            whole = F.struct(*(x.cast("double").alias(f) for f, x in zip(indicator.fields, found, strict=True)))
            none = F.lit(None).cast(T.StructType([T.StructField(f, T.DoubleType()) for f in indicator.fields]))
            out[name] = F.when(ready, whole).otherwise(none)
        else:
            out[name] = F.when(ready, found.cast("double"))
    for layer in layers.layers:
        if layer:
            d = d.withColumns(layer)
    if out:
        d = d.withColumns(out)
    d = d.drop(*(c for layer in layers.layers for c in layer))

    kernels = [(name, i, values, [f"_seen_{w}_{c}" if w > 1 else c for c in i.inputs], w - 1) for name, (i, values, w) in todo.items() if i.kernel]
    if kernels:
        d = _run_kernels(d, kernels)
    d = d.select(*(F.col(f"`{c}`") for c in [*kept, *todo]))
    return d.orderBy(*S.series_keys(df), "timestamp") if ordered else d


def _run_kernels(d: DataFrame, kernels: list) -> DataFrame:
    """All recursive indicators of a series in one grouped pass; Arrow keeps NaN apart from null.

    A row with a null in one of an indicator's inputs has a null value, and the recursion goes from the row before it to the row after it.
    """
    keys = S.series_keys(d)
    new = [T.StructField(name, T.StructType([T.StructField(f, T.DoubleType()) for f in i.fields]) if i.fields else T.DoubleType()) for name, i, *_ in kernels]
    schema = T.StructType([*d.schema.fields, *new])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_i")
        read = {c: (x.is_valid().to_numpy(zero_copy_only=False), x.cast(pa.float64()).to_numpy(zero_copy_only=False)) for c in {c for *_, cs, _ in kernels for c in cs} for x in [table.column(c).combine_chunks()]}
        for name, indicator, values, columns, skip in kernels:
            whole = np.logical_and.reduce([read[c][0] for c in columns])
            whole[:skip] = False
            found = [_placed(x, whole) for x in indicator.kernel(*(read[c][1][whole] for c in columns), **values)]
            if indicator.fields:
                missing = found[-1].is_null()
                value = pa.StructArray.from_arrays(found, list(indicator.fields), mask=missing)
            else:
                value = found[0]
            table = table.append_column(name, value)
        return table

    if not keys:
        d = d.withColumn("_one", F.lit(1))
        schema = T.StructType([*d.schema.fields, *new])
        return d.groupBy("_one").applyInArrow(run, schema).drop("_one")
    return d.groupBy(*keys).applyInArrow(run, schema)


def _placed(values: list, rows: np.ndarray) -> pa.Array:
    """values at the rows that are True, null elsewhere."""
    if rows.all():
        return pa.array(values, pa.float64())
    at = np.cumsum(rows) - 1
    return pa.array([None, *values], pa.float64()).take(pa.array(np.where(rows, at + 1, 0)))
