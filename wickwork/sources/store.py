"""Candle store: Parquet by symbol, timeframe, year and month, with keep-last upserts.

Rows carry ``ingest_seq``, which grows with each save; reads and writes keep the last row of a timestamp. A save touches
only the months it has rows for (dynamic partition overwrite), which is atomic per month, not across months: one writer
per series.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.functions import schema as S
from wickwork.functions.timeframe import bounds

PARTS = ("symbol", "timeframe", "year", "month")
_STORED = "timestamp timestamp_ntz, open double, high double, low double, close double, volume double, ingest_seq long, symbol string, timeframe string, year int, month int"


def symbol_path(symbol: str) -> str:
    """AAVE/USDC, AAVE-USDC and aave-usdc are one symbol."""
    return symbol.replace("/", "-").lower()


def symbol_path_column(symbol: Column) -> Column:
    return F.lower(F.translate(symbol, "/", "-"))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(at) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(at))


def stored(spark: SparkSession, data_dir: str) -> DataFrame:
    """All stored rows, versions included; an empty frame where nothing is stored."""
    if not exists(spark, data_dir):
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).parquet(data_dir)


def _candles(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in S.CANDLE])


def _in_place(df: DataFrame) -> DataFrame:
    """Without rows that lie in another month's folder."""
    return df.where((F.year("timestamp") == F.col("year")) & (F.month("timestamp") == F.col("month")))


def months_between(lo: datetime | None, hi: datetime | None) -> Column:
    """Partition predicate for inclusive bounds: a filter on timestamp alone prunes no folders."""
    key, out = F.col("year") * 100 + F.col("month"), F.lit(True)
    if lo is not None:
        out = out & (key >= lo.year * 100 + lo.month)
    if hi is not None:
        out = out & (key <= hi.year * 100 + hi.month)
    return out


def load_range(spark: SparkSession, data_dir: str, symbol: str, timeframe: str, start=None, end=None) -> DataFrame:
    """Candles of one series between inclusive bounds, last version of each, in order of time."""
    lo, hi = bounds(start, end, timeframe)
    df = stored(spark, data_dir).where((F.col("symbol") == symbol_path(symbol)) & (F.col("timeframe") == timeframe))
    if lo is not None or hi is not None:
        df = df.where(months_between(lo, hi))
    return _candles(in_range(S.keep_last(df), lo, hi)).orderBy("timestamp")


def in_range(df: DataFrame, lo: datetime | None, hi: datetime | None) -> DataFrame:
    """Rows between inclusive bounds; below a keep-last the optimizer moves this into the scan, since timestamp is its key."""
    if lo is not None:
        df = df.where(F.col("timestamp") >= F.lit(lo).cast("timestamp_ntz"))
    if hi is not None:
        df = df.where(F.col("timestamp") <= F.lit(hi).cast("timestamp_ntz"))
    return df


def load(spark: SparkSession, data_dir: str, symbol: str, timeframe: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """All candles of a series, or those of a year, or of a month of it."""
    if month is not None and (year is None or not 1 <= month <= 12):
        raise ValueError("a month needs a year and lies between 1 and 12")
    df = stored(spark, data_dir).where((F.col("symbol") == symbol_path(symbol)) & (F.col("timeframe") == timeframe))
    if year is not None:
        df = df.where(F.col("year") == year)
    if month is not None:
        df = df.where(F.col("month") == month)
    return _candles(S.keep_last(df)).orderBy("timestamp")


def touched(old: DataFrame, new: DataFrame) -> DataFrame:
    """Stored rows of the months that new has rows for; a join on the folders' columns, which prunes the scan at run time."""
    return _in_place(old).join(new.select(*PARTS).distinct(), list(PARTS), "left_semi")


def save(df: DataFrame, data_dir: str, symbol: str | None = None, timeframe: str | None = None) -> None:
    """Upserts candles: new rows win, rows in the wrong month's folder go, other months stay untouched. An empty frame changes nothing.

    Symbol and timeframe may be given or be columns. Rows of one timestamp within df are ordered by its ingest_seq, or
    else as they come.
    """
    S.need(df, ("timestamp", *S.PRICES))
    spark = df.sparkSession
    seq = F.col("ingest_seq") if "ingest_seq" in df.columns else F.monotonically_increasing_id()
    df = df.select(
        F.col("timestamp").cast("timestamp_ntz"), *(F.col(c).cast("double") for c in S.PRICES), seq.cast("long").alias("ingest_seq"),
        symbol_path_column(F.lit(symbol) if symbol else F.col("symbol")).alias("symbol"), (F.lit(timeframe) if timeframe else F.col("timeframe")).alias("timeframe"),
        F.year("timestamp").alias("year"), F.month("timestamp").alias("month"),
    )
    df = S.keep_last(df)
    if exists(spark, data_dir):
        old = touched(stored(spark, data_dir), df).select(*df.columns)
        newer = df.withColumn("_new", F.lit(1)).unionByName(old.withColumn("_new", F.lit(0)))
        rank = F.struct("_new", "ingest_seq")
        df = S.keep_last(newer.withColumn("_rank_by", rank), seq="_rank_by").drop("_new", "_rank_by")
    last = F.lit(datetime.now().timestamp() * 1e6).cast("long")  # noqa: DTZ005
    df = df.withColumn("ingest_seq", F.greatest("ingest_seq", last))
    out = df.repartition(*PARTS).sortWithinPartitions(*PARTS, "timestamp")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(data_dir)


def newest(df: DataFrame, limit: int = 300, exclude: DataFrame | None = None) -> DataFrame:
    """The newest candles of each series but those whose (keys, timestamp) stand in exclude, which may be large: an anti-join, then a ranked limit."""
    keys = S.series_keys(df)
    if exclude is not None:
        df = df.join(exclude.select(*keys, "timestamp"), [*keys, "timestamp"], "left_anti")
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(F.col("timestamp").desc())
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit).drop("_n")


def update(spark: SparkSession, data_dir: str, symbol: str, timeframe: str, latest: DataFrame) -> DataFrame:
    """Merges the latest candles into the store and returns the series. A stored last candle that was still open is corrected."""
    save(latest, data_dir, symbol, timeframe)
    return load(spark, data_dir, symbol, timeframe)
