"""Schemas of candles and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICES = ("open", "high", "low", "close", "volume")
KEYS = ("symbol", "timeframe")
CANDLE = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("timeframe", T.StringType()), T.StructField("timestamp", T.TimestampNTZType()), *(T.StructField(c, T.DoubleType()) for c in PRICES)])


def series_keys(df: DataFrame) -> list[str]:
    """The columns that tell series apart; none where the frame is one series."""
    return [c for c in KEYS if c in df.columns]


def in_order(df: DataFrame) -> WindowSpec:
    return Window.partitionBy(*series_keys(df)).orderBy("timestamp")


def need(df: DataFrame, columns) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def _pick(df: DataFrame, by, order: Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, by=("symbol", "timeframe", "timestamp"), seq: str | Column = "ingest_seq") -> DataFrame:
    """One row per key: the one with the largest seq (a column or its name). A rank filter of 1 is pruned before the shuffle (WindowGroupLimit)."""
    return _pick(df, by, (F.col(seq) if isinstance(seq, str) else seq).desc())


def keep_first(df: DataFrame, by=("symbol", "timeframe", "timestamp"), seq: str | Column = "ingest_seq") -> DataFrame:
    return _pick(df, by, (F.col(seq) if isinstance(seq, str) else seq).asc())
