"""Gap fill: a regular grid per series, with prices carried forward."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork.functions import schema as S
from wickwork.functions.timeframe import at_micros, micros, seconds


def ffill(df: DataFrame, every: str, seq: str | None = None) -> DataFrame:
    """df on the grid from each series' first to its last candle, with is_imputed.

    Of rows with one timestamp the first stays: by seq, else by ingest_seq where there is one, else by the prices themselves, smallest
    first (nulls last), so that runs agree. Rows off the grid are left out but count for the
    bounds. Prices carry their own last value, a missing volume is 0; nulls in observed rows are filled the
    same way and aren't imputed rows. Timestamps are cut to milliseconds.
    """
    S.need(df, ("timestamp", *S.PRICES))
    keys = S.series_keys(df)
    order = F.col(seq or "ingest_seq") if seq or "ingest_seq" in df.columns else F.struct(*(x for c in S.PRICES for x in (F.col(c).isNull(), F.col(c))))
    df = df.withColumn("timestamp", at_micros(F.floor(micros(F.col("timestamp").cast("timestamp_ntz")) / 1000).cast("long") * 1000))
    df = S.keep_first(df, (*keys, "timestamp"), order)
    ends = df.groupBy(*keys).agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).where("lo is not null")
    grid = _grid(ends, keys, every)
    seen = df.select(*keys, "timestamp", *S.PRICES, F.lit(True).alias("_seen"))
    w = Window.partitionBy(*keys).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    filled = grid.join(seen, [*keys, "timestamp"], "left").withColumns(
        {c: F.last(c, ignorenulls=True).over(w) for c in S.PRICES if c != "volume"} | {"volume": F.coalesce("volume", F.lit(0.0)), "is_imputed": F.col("_seen").isNull()}
    )
    return filled.select(*keys, "timestamp", *S.PRICES, "is_imputed")


def _grid(ends: DataFrame, keys: list[str], every: str, run: int = 4096) -> DataFrame:
    """(keys, timestamp) from lo to hi of each row. In runs, so that no row ever holds a long series as one array."""
    step = seconds(every)
    n = F.floor((micros(F.col("hi")) - micros(F.col("lo"))) / (step * 1_000_000)).cast("long")
    g = ends.select(*keys, "lo", n.alias("n")).select(*keys, "lo", "n", F.explode(F.expr(f"sequence(0L, n div {run})")).alias("k"))
    g = g.select(*keys, "lo", F.explode(F.expr(f"sequence(k * {run}, least(n, k * {run} + {run - 1}))")).alias("i"))
    return g.select(*keys, F.expr(f"lo + make_dt_interval(0, 0, 0, i * {step})").alias("timestamp"))


def imputed_count(filled: DataFrame) -> DataFrame:
    """Imputed rows per series."""
    return filled.groupBy(*S.series_keys(filled)).agg(F.count_if("is_imputed").alias("imputed"))


def as_epoch_millis(filled: DataFrame) -> DataFrame:
    return filled.withColumn("timestamp", F.floor(micros(F.col("timestamp")) / 1000).cast("long"))
