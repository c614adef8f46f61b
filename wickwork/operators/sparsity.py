"""Data quality of candle series: expected and missing candles, gaps.

Timestamps without a zone hold UTC, whatever the session's time zone.
"""

from __future__ import annotations

import re
import warnings
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickwork.functions.timeframe import SECONDS, at_micros, micros

ASSET = "^[a-z0-9]+-[a-z0-9]+$"
_ZONE = "(?i)(Z|UTC|[+-][0-9]{2}(:?[0-9]{2})?)$"


def _floor2(x: Column) -> Column:
    return F.floor(x * 100) / 100


def wanted(df: DataFrame, assets: list[str] | None) -> DataFrame:
    """Rows of the given assets, whatever their case; blanks are ignored and an empty list means all."""
    names = sorted({a.strip().lower() for a in assets or [] if a.strip()})
    return df.where(F.lower(F.trim("symbol")).isin(names)) if names else df


def timestamp_micros(column: Column, kind: str) -> Column:
    """Timestamps of any readable type as microseconds; text that can't be read is null, text without a zone is UTC."""
    if kind == "timestamp_ntz":
        return micros(column)
    if kind == "timestamp":
        return F.unix_micros(column)
    if kind == "date":
        return F.unix_date(column).cast("long") * 86_400_000_000
    if kind == "string":
        text = F.trim(column)
        zoned = text.rlike("[0-9]:[0-9]") & text.rlike(_ZONE)
        return F.when(zoned, F.unix_micros(F.try_to_timestamp(text))).otherwise(micros(text.try_cast("timestamp_ntz")))
    raise ValueError(f"timestamps cannot be of type {kind}")


def _cadence() -> Column:
    return F.create_map(*(x for k, v in SECONDS.items() for x in (F.lit(k), F.lit(v * 1_000_000))))[F.col("timeframe")]


def _distinct(df: DataFrame) -> DataFrame:
    """(symbol, timeframe, us, files...) once per timestamp of well-named series."""
    kind = df.schema["timestamp"].dataType.simpleString()
    df = df.withColumn("us", timestamp_micros(F.col("timestamp"), kind)).where(F.col("us").isNotNull() & F.col("symbol").rlike(ASSET) & F.col("timeframe").isin(*SECONDS))
    return df


def gaps(df: DataFrame) -> DataFrame:
    """(symbol, timeframe, timestamp, missing, extra_seconds): each gap, at the candle after it."""
    d = _distinct(df).groupBy("symbol", "timeframe", "us").agg(F.first("timestamp").alias("timestamp")).withColumn("cadence", _cadence())
    delta = F.col("us") - F.lag("us").over(Window.partitionBy("symbol", "timeframe").orderBy("us"))
    return d.withColumn("delta", delta).where("delta > cadence").select("symbol", "timeframe", "timestamp", F.expr("delta div cadence - 1").alias("missing"), ((F.col("delta") - F.col("cadence")) / 1e6).alias("extra_seconds"))


def report(df: DataFrame, assets: list[str] | None = None, file: str | None = None) -> DataFrame:
    """One row per (asset, timeframe) with a readable timestamp.

    file names the column that tells files apart; without it a month is a file, as in the store. Files are counted in the same pass: a
    timestamp carries its files, and those that the timestamp before it has, too, are dropped before they are gathered.
    """
    d = _distinct(wanted(df, assets))
    part = F.col(file) if file else F.date_format(at_micros(F.col("us")), "yyyy-MM")
    one = d.groupBy("symbol", "timeframe", "us").agg(F.collect_set(part).alias("files")).withColumn("cadence", _cadence())
    delta = F.col("us") - F.lag("us").over(Window.partitionBy("symbol", "timeframe").orderBy("us"))
    one = one.withColumn("delta", delta).withColumn("gap", F.expr("case when delta > cadence then delta div cadence - 1 end"))
    one = one.withColumn("files", F.array_except("files", F.coalesce(F.lag("files").over(Window.partitionBy("symbol", "timeframe").orderBy("us")), F.array().cast("array<string>"))))
    s = one.groupBy("symbol", "timeframe").agg(
        F.min("us").alias("lo"), F.max("us").alias("hi"), F.count("*").alias("actual"), F.first("cadence").alias("cadence"), F.count("gap").alias("gap_count"),
        F.avg("gap").alias("mean"), F.min("gap").alias("shortest_gap_missing"), F.max("gap").alias("largest_gap_missing"),
        F.avg(F.when(F.col("gap").isNotNull(), (F.col("delta") - F.col("cadence")) / 1e6)).alias("extra"),
        F.size(F.array_distinct(F.flatten(F.collect_set(F.when(F.size("files") > 0, F.col("files")))))).cast("long").alias("files_processed"),
    )
    s = s.withColumn("expected", F.expr("(hi - lo) div cadence + 1")).withColumn("missing", F.greatest(F.col("expected") - F.col("actual"), F.lit(0)))
    return s.select(
        F.col("symbol").alias("asset"), "timeframe", at_micros(F.col("lo")).alias("range_start"), at_micros(F.col("hi")).alias("range_end"), "files_processed", "actual", "expected", "missing",
        _floor2(F.col("actual") / F.col("expected")).alias("availability"), _floor2(F.col("missing") / F.col("expected")).alias("sparsity"),
        "gap_count", F.coalesce(_floor2(F.col("mean")), F.lit(0.0)).alias("avg_gap_missing"), "shortest_gap_missing", "largest_gap_missing",
        F.coalesce(_floor2(F.col("extra")), F.lit(0.0)).alias("avg_extra_gap_seconds"),
    )


def _schemas(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The type of the timestamp column by path. Spark reads all footers at once, in tasks; where that fails or types differ, halves are looked at apart."""
    found: dict[str, str] = {}
    todo = [paths] if paths else []
    while todo:
        some = todo.pop()
        try:
            kind = spark.read.option("mergeSchema", "true").parquet(*some).schema["timestamp"].dataType.simpleString()
            timestamp_micros(F.col("timestamp"), kind)
            found |= dict.fromkeys(some, kind)
        except Exception as e:  # noqa: BLE001
            if len(some) == 1:
                warnings.warn(f"{some[0]} is left out: {str(e).splitlines()[0]}", stacklevel=3)
            else:
                todo += [some[: len(some) // 2], some[len(some) // 2 :]]
    return found


def _qualified(spark: SparkSession, path: str) -> str:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def read_timestamps(spark: SparkSession, files: list[tuple[str, str, str]]) -> DataFrame:
    """(symbol, timeframe, timestamp, file) of Parquet files given as (symbol, timeframe, path), whose timestamp columns may differ in type.

    Only the timestamp column is read. A file that can't be read, or has no readable timestamp column, is left out with a warning.
    Files of one type are one scan; rows meet their series by the file's whole path.
    """
    files = [(s, t, _qualified(spark, p), p) for s, t, p in files]
    by_kind: dict[str, list] = defaultdict(list)
    kinds = _schemas(spark, sorted({at for *_, at, _ in files}))
    for symbol, timeframe, at, path in files:
        if at in kinds:
            by_kind[kinds[at]].append((at, symbol, timeframe, path))
    out = None
    for kind, found in sorted(by_kind.items()):
        names = spark.createDataFrame(found, "_path string, symbol string, timeframe string, file string")
        d = spark.read.schema(f"timestamp {kind}").option("ignoreCorruptFiles", "true").parquet(*sorted({at for at, *_ in found})).select("timestamp", F.input_file_name().alias("_at"))
        # input_file_name() gives a URI: file:///x%20y, where the path is file:/x y
        d = d.withColumn("_at", F.regexp_replace(F.url_decode(F.replace("_at", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")).join(names, F.col("_at") == F.regexp_replace("_path", "^file:/+", "file:/"))
        d = d.select("symbol", "timeframe", at_micros(timestamp_micros(F.col("timestamp"), kind)).alias("timestamp"), "file")
        out = d if out is None else out.unionByName(d)
    return out if out is not None else spark.createDataFrame([], "symbol string, timeframe string, timestamp timestamp_ntz, file string")


def find_files(spark: SparkSession, base_path: str, assets: list[str] | None = None) -> list[tuple[str, str, str]]:
    """(asset, timeframe, path) of the month files under base_path/asset/timeframe/year/MM.parquet, on any file system that Spark reads.

    What doesn't fit the layout is left out with a warning, as are assets that were asked for and aren't there.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(base_path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        warnings.warn(f"{base_path} does not exist", stacklevel=2)
        return []

    def inside(path, folders: bool) -> list[tuple[str, object]]:
        found = ((x.getPath().getName(), x.getPath()) for x in fs.listStatus(path) if x.isDirectory() is folders)
        return sorted(((n, p) for n, p in found if not n.startswith(("_", "."))), key=lambda x: x[0])

    def fits(kind: str, name: str, pattern: str, where: str, hint: str) -> bool:
        if re.fullmatch(pattern, name):
            return True
        warnings.warn(f"{kind} {name!r}{where} is left out{hint}", stacklevel=4)
        return False

    asked = {a.strip().lower() for a in assets or [] if a.strip()}
    there = [(a, p) for a, p in inside(at, True) if fits("asset", a, ASSET, "", ": use lower case" if re.fullmatch(ASSET, a.lower()) else "")]
    for a in sorted(asked - {a for a, _ in there}):
        warnings.warn(f"asset {a!r} was not found", stacklevel=2)
    found = []
    for a, p in there:
        if asked and a not in asked:
            continue
        for t, q in inside(p, True):
            if not fits("timeframe", t, "|".join(SECONDS), f" of {a}", ": use lower case" if t.lower() in SECONDS else ""):
                continue
            for y, r in inside(q, True):
                if not fits("year", y, "[0-9]{4}", f" of {a}/{t}", ""):
                    continue
                for m, file in inside(r, False):
                    number = m.removesuffix(".parquet")
                    hint = ": use a leading zero" if m.endswith(".parquet") and number.isdigit() and 1 <= int(number) <= 12 else ""
                    if fits("month file", m, r"(0[1-9]|1[0-2])\.parquet", f" of {a}/{t}/{y}", hint):
                        found.append((a, t, file.toString()))
    return found


def report_path(spark: SparkSession, base_path: str, assets: list[str] | None = None) -> DataFrame:
    """The report over all month files under a folder; empty, with its columns, where there are none. Values that can't be read as timestamps count nowhere."""
    return report(read_timestamps(spark, find_files(spark, base_path, assets)), assets, "file")
