"""Queries by name, with the SQL that gives the same rows.

The test tables hold no candles, so candles are made of ``events``: a symbol per event type, the value as price, the
number of events as volume.
"""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.functions import schema as S
from wickwork.functions.timeframe import SECONDS, bounds, expected_pages_column, is_base, micros, minutes, ratio, seconds
from wickwork.operators import impute, sparsity
from wickwork.operators import vif as V
from wickwork.operators.indicators import REGISTRY, add_indicators, output_name
from wickwork.operators.indicators.synthetic import synthetic
from wickwork.plans import sql
from wickwork.session import remove_at_exit, shared_folder
from wickwork.sources import exchange, store
from wickwork.sources.candles import from_events

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return keep


def candles(spark: SparkSession, sf_dir: str, timeframe: str = "1h") -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), timeframe)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query(f"{sql.candles('1h')} SELECT * FROM candles")
def candles_1h(spark, sf_dir):
    return candles(spark, sf_dir)


def _ranged(spark, sf_dir, start, end, timeframe="1h"):
    return store.in_range(candles(spark, sf_dir, timeframe), *bounds(start, end, timeframe))


@query(f"{sql.candles('1h')} SELECT * FROM candles WHERE timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-09 17:00:00'")
def range_bounded(spark, sf_dir):
    return _ranged(spark, sf_dir, "2024-01-05", "2024-01-09T17:00:00Z")


@query(f"{sql.candles('1h')} SELECT * FROM candles WHERE timestamp <= TIMESTAMP '2024-01-03 23:00:00'")
def range_end_floor(spark, sf_dir):
    return _ranged(spark, sf_dir, None, "2024-01-03 00:00:00")


@query(f"{sql.candles('6h')} SELECT * FROM candles WHERE timestamp BETWEEN TIMESTAMP '2024-01-29 00:30:00' AND TIMESTAMP '2024-02-01 18:00:00'")
def range_month_edge(spark, sf_dir):
    return _ranged(spark, sf_dir, "2024-01-29 00:30", "2024-02-01", "6h")


_VERSIONS = "v AS (SELECT event_type AS symbol, '1h' AS timeframe, time_bucket(INTERVAL 1 hour, ts) AS timestamp, value AS close, event_id AS ingest_seq FROM events)"


def _versions(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(F.col("event_type").alias("symbol"), F.lit("1h").alias("timeframe"), F.window("ts", "1 hour")["start"].alias("timestamp"), F.col("value").alias("close"), F.col("event_id").alias("ingest_seq"))


@query(f"WITH {_VERSIONS} SELECT symbol, timeframe, timestamp, arg_max(close, ingest_seq) AS close, max(ingest_seq) AS ingest_seq FROM v GROUP BY ALL")
def dedupe_keep_last(spark, sf_dir):
    return S.keep_last(_versions(spark, sf_dir))


@query(f"WITH {_VERSIONS} SELECT symbol, timeframe, timestamp, arg_min(close, ingest_seq) AS close, min(ingest_seq) AS ingest_seq FROM v GROUP BY ALL")
def dedupe_keep_first(spark, sf_dir):
    return S.keep_first(_versions(spark, sf_dir))


def _folder(spark: SparkSession) -> str:
    """A fresh folder for a query's own store, on what all executors see. It goes when the program ends."""
    folder = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    remove_at_exit(spark, folder)
    return folder


def _stored(spark, sf_dir, timeframe="1h"):
    folder = _folder(spark)
    store.save(candles(spark, sf_dir, timeframe), folder)
    return folder


def _all(spark, folder):
    return store._candles(S.keep_last(store.stored(spark, folder)))


@query(f"{sql.candles('1h')} SELECT * FROM candles")
def store_roundtrip(spark, sf_dir):
    return _all(spark, _stored(spark, sf_dir))


@query(
    f"{sql.candles('1h')} SELECT symbol, timeframe, timestamp, open, high, low, CASE WHEN timestamp >= TIMESTAMP '2024-01-20' THEN close + 1 ELSE close END AS close, volume FROM candles"
)
def store_upsert(spark, sf_dir):
    folder = _stored(spark, sf_dir)
    late = candles(spark, sf_dir).where("timestamp >= timestamp_ntz'2024-01-20'").withColumn("close", F.col("close") + 1)
    store.save(late, folder)
    return _all(spark, folder)


@query(f"{sql.candles('6h')} SELECT * FROM candles WHERE symbol = 'purchase' AND year(timestamp) = 2024 AND month(timestamp) = 1")
def load_year_month(spark, sf_dir):
    return store.load(spark, _stored(spark, sf_dir, "6h"), "purchase", "6h", 2024, 1)


@query(f"{sql.candles('1h')} SELECT * FROM candles WHERE hour(timestamp) % 2 = 1 QUALIFY row_number() OVER (PARTITION BY symbol, timeframe ORDER BY timestamp DESC) <= 50")
def latest_n_exclude(spark, sf_dir):
    c = candles(spark, sf_dir)
    return store.newest(c, 50, c.where("hour(timestamp) % 2 = 0"))


@query(f"{sql.filled('1h')} SELECT * FROM filled")
def ffill_impute(spark, sf_dir):
    return impute.ffill(candles(spark, sf_dir), "1h")


@query(f"{sql.filled('1h')} SELECT symbol, timeframe, count(*) FILTER (is_imputed) AS imputed FROM filled GROUP BY ALL")
def imputed_count(spark, sf_dir):
    return impute.imputed_count(impute.ffill(candles(spark, sf_dir), "1h"))


@query(f"{sql.filled('6h')} SELECT symbol, timeframe, epoch_ms(timestamp) AS timestamp, close, volume FROM filled")
def ffill_epoch_millis(spark, sf_dir):
    return impute.as_epoch_millis(impute.ffill(candles(spark, sf_dir, "6h"), "6h")).select("symbol", "timeframe", "timestamp", "close", "volume")


def _assets(spark, sf_dir):
    both = candles(spark, sf_dir, "1h").unionByName(candles(spark, sf_dir, "5m"))
    return both.withColumn("symbol", F.concat("symbol", F.lit("-usd")))


@query(sql.SPARSITY)
def sparsity_report(spark, sf_dir):
    return sparsity.report(_assets(spark, sf_dir), [" CLICK-usd", "view-usd", "error-usd", ""])


@query(sql.SPARSITY_FILES)
def sparsity_files(spark, sf_dir):
    """The report over month files under asset/timeframe/year/MM.parquet, whose timestamps are without zone, with zone, or text; other files there are left out."""
    folder = _folder(spark)
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    path = spark._jvm.org.apache.hadoop.fs.Path
    series = {"click-usd": "timestamp", "view-usd": "date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")", "error-usd": "if(hour(timestamp) = 3, 'bad-ts', date_format(timestamp, 'yyyy-MM-dd HH:mm:ss'))", "Bad": "timestamp"}
    for asset, column in series.items():
        for timeframe, name in (("1h", "01"), ("2h", "01"), ("2h", "1")):
            c = candles(spark, sf_dir, timeframe).where(F.col("symbol") == asset.split("-")[0].lower() if asset != "Bad" else F.lit(True)).where("month(timestamp) = 1")
            c.select(F.expr(column).alias("timestamp"), "close").coalesce(1).write.parquet(f"{folder}/new")
            part = next(s.getPath() for s in fs.listStatus(path(f"{folder}/new")) if s.getPath().getName().endswith(".parquet"))
            fs.mkdirs(path(f"{folder}/{asset}/{timeframe}/2024"))
            fs.rename(part, path(f"{folder}/{asset}/{timeframe}/2024/{name}.parquet"))
            fs.delete(path(f"{folder}/new"), True)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return sparsity.report_path(spark, folder, ["CLICK-usd", "view-usd", "error-usd", "gone-usd"])


@query(
    f"{sql.candles('1h')}, d AS (SELECT symbol, timeframe, timestamp, date_diff('second', lag(timestamp) OVER (PARTITION BY symbol ORDER BY timestamp), timestamp) AS s FROM candles) "
    "SELECT symbol || '-usd' AS symbol, timeframe, timestamp, s // 3600 - 1 AS missing, (s - 3600)::DOUBLE AS extra_seconds FROM d WHERE s > 3600"
)
def gap_list(spark, sf_dir):
    return sparsity.gaps(_assets(spark, sf_dir).where("timeframe = '1h'"))


@query(f"{sql.synthetic('1h', 6)} SELECT symbol, timestamp, high_6 AS high_6h, low_6 AS low_6h, close_6 AS close_6h FROM synthetic")
def synthetic_ohlc(spark, sf_dir):
    return synthetic(candles(spark, sf_dir), "6h", "1h").select("symbol", "timestamp", "high_6h", "low_6h", "close_6h")


_REQUESTS = {"symbols": ["AAA/USD", "BAD/USD", "CCC/USD"], "timeframes": ["5m", "1h"], "start": "2024-01-01T00:30:00Z", "end": "2024-01-03T12:10:00Z"}


@query(sql.FETCHED)
def fetch_bounded(spark, sf_dir):
    """Windows of pages as partitions; the fetcher follows a rule."""
    return exchange.fetch(spark, "wickwork.sources.sample:fetch", on_error="row", pagesPerTask=2, **_REQUESTS)[0]


@query("SELECT DISTINCT 'BAD/USD' AS symbol, unnest(['5m', '1h']) AS timeframe, 'unknown symbol BAD/USD' AS error")
def fetch_errors(spark, sf_dir):
    """What could not be fetched, one row per window; here, per request."""
    return exchange.fetch(spark, "wickwork.sources.sample:fetch", on_error="row", pagesPerTask=2, **_REQUESTS)[1].distinct()


@query(sql.fetched("TIMESTAMP '2024-01-30'", "TIMESTAMP '2024-01-31 23:00:00'", ("AAA/USD",), ("1h",)))
def fetch_open_ended(spark, sf_dir):
    """Without an end: a cursor goes on until the exchange has no more."""
    return exchange.fetch(spark, "wickwork.sources.sample:fetch", ["AAA/USD"], ["1h"], start="2024-01-30")[0]


@query(sql.fetched("TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-01-02 23:00:00'", ("AAA/USD", "CCC/USD"), ("5m",)))
def fetch_retried(spark, sf_dir):
    """Each request fails at first and is made again, under a budget that all tasks share."""
    return exchange.fetch(spark, "wickwork.sources.sample:flaky", ["AAA/USD", "CCC/USD"], ["5m"], start="2024-01-01", end="2024-01-02", budget_per_second=500, pagesPerTask=1, basePause=0.01)[0]


@query(sql.fetched("TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-01-04 23:00:00'", ("AAA/USD", "CCC/USD"), ("1h", "5m"), stored=True))
def fetch_and_save(spark, sf_dir):
    """Download into the store, where one symbol fails; what is stored then."""
    folder = _folder(spark)
    exchange.fetch_and_save(spark, "wickwork.sources.sample:fetch", ["AAA/USD", "BAD/USD", "CCC/USD"], ["1h", "5m"], folder, start="2024-01-01", end="2024-01-04")
    return _all(spark, folder)


@query(sql.TIMEFRAMES)
def timeframe_ratios(spark, sf_dir):
    """Timeframes with their minutes, bases and ratios; unknown ones have none."""
    names = [*SECONDS, "7m"]
    rows = [(t, minutes(t) if t in SECONDS else None, b, is_base(t, b), ratio(t, b) if is_base(t, b) else None) for t in names for b in names]
    return spark.createDataFrame(rows, "timeframe string, minutes long, base string, is_base boolean, ratio long")


@query(sql.LATEST)
def fetch_latest(spark, sf_dir):
    """The newest 40 candles that the exchange has of each series, without those of even hours."""
    known = spark.range(31 * 24).select(F.lit("AAA/USD").alias("symbol"), F.lit("1h").alias("timeframe"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id)").alias("timestamp")).where("hour(timestamp) % 2 = 0")
    return exchange.fetch_latest(spark, "wickwork.sources.sample:fetch", ["AAA/USD", "BAD/USD"], ["5m", "1h"], 40, known, on_error="row")[0]


@query(sql.UPDATED)
def exchange_update(spark, sf_dir):
    """A stored series brought up to date from the exchange: stored candles stay as they are, newer ones come in."""
    folder = _folder(spark)
    old = exchange.fetch(spark, "wickwork.sources.sample:fetch", ["AAA/USD"], ["1h"], start="2024-01-29", end="2024-01-30T12:00:00")[0]
    store.save(old.withColumn("close", F.lit(0.0)), folder)
    return exchange.update(spark, folder, "wickwork.sources.sample:fetch", "AAA/USD", "1h", 48)


@query(f"{sql.candles('6h')} SELECT symbol, timeframe, timestamp, open, high, low, CASE WHEN timestamp >= TIMESTAMP '2024-01-15' THEN close * 2 ELSE close END AS close, volume FROM candles WHERE symbol = 'view'")
def store_update(spark, sf_dir):
    """A stored series merged with later candles, of which some are known and corrected."""
    c, folder = candles(spark, sf_dir, "6h").where("symbol = 'view'"), _folder(spark)
    store.save(c.where("timestamp < timestamp_ntz'2024-01-20'"), folder)
    return store.update(spark, folder, "view", "6h", c.where("timestamp >= timestamp_ntz'2024-01-15'").withColumn("close", F.col("close") * 2))


@query("SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN epoch_us(date_trunc('second', ts)) ELSE -1 END AS us FROM events")
def timestamp_coercion(spark, sf_dir):
    """Text timestamps as microseconds; what can't be read is null, here -1."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = F.when(F.col("event_id") % 7 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("bad-ts"))
    return e.select("event_id", F.coalesce(sparsity.timestamp_micros(text, "string"), F.lit(-1)).alias("us"))


def _indicator(spark, sf_dir, name, timeframe="1h", **params) -> DataFrame:
    column = output_name(REGISTRY[name], params, timeframe)
    d = add_indicators(candles(spark, sf_dir), [(name, timeframe, params)], "1h", ordered=False)
    fields = REGISTRY[name].fields
    out = [F.round(f"{column}.{f}", 6).alias(f) for f in fields] or [F.round(column, 6).alias(column)]
    return d.select("symbol", "timestamp", *out)


def _register(name: str, query_name: str, timeframe: str = "1h", **params) -> None:
    def run(spark, sf_dir):
        return _indicator(spark, sf_dir, name, timeframe, **params)

    run.__name__ = query_name
    query(sql.indicator(name, output_name(REGISTRY[name], params, timeframe), seconds(timeframe) // 3600, REGISTRY[name].defaults | params))(run)


for _name in REGISTRY:
    _register(_name, f"ind_{_name}")
_register("rsi", "ind_rsi_6h_synthetic", "6h")
_register("mom", "ind_mom_6h_synthetic", "6h")


_HOLED = ("adosc", "adx", "atr", "cmo", "kama", "macd", "rsi", "stochrsi", "trix")


def _register_holed(name: str) -> None:
    """The recursive indicators where the first candles, and every eleventh one, have no prices."""

    def run(spark, sf_dir):
        c = candles(spark, sf_dir)
        hole = (F.hour("timestamp") * 31 + F.day("timestamp") * 7) % 11 == 0
        holed = c.select("symbol", "timeframe", "timestamp", *(F.when(~hole, F.col(x)).alias(x) for x in S.PRICES))
        column = output_name(REGISTRY[name], {}, "1h")
        d = add_indicators(holed, [(name, "1h", {})], "1h", ordered=False)
        return d.select("symbol", "timestamp", *([F.round(f"{column}.{f}", 6).alias(f) for f in REGISTRY[name].fields] or [F.round(column, 6).alias(column)]))

    run.__name__ = f"ind_{name}_nulls"
    query(sql.indicator(name, output_name(REGISTRY[name], {}, "1h"), 1, REGISTRY[name].defaults, holes="(hour(timestamp) * 31 + day(timestamp) * 7) % 11 = 0"))(run)


for _name in _HOLED:
    _register_holed(_name)


@query(sql.BATCH)
def ind_batch(spark, sf_dir):
    specs = [("mom", "1h", {}), ("roc", "1h", {"timeperiod": 5}), ("willr", "1h", {}), ("bbands", "1h", {}), ("mom", "6h", {"timeperiod": 3}), ("wma", "2h", {"timeperiod": 8})]
    d = add_indicators(candles(spark, sf_dir), specs, "1h", ordered=False)
    names = ["mom_10_1h", "roc_5_1h", "willr_14_1h", "mom_3_6h", "wma_8_2h"]
    return d.select("symbol", "timestamp", *(F.round(c, 6).alias(c) for c in names), F.round("bbands_20_2_0_2_0_1h.upperband", 6).alias("upperband"))


def _numbers(spark, sf_dir, *columns) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return d.withColumn("net", F.col("l_extendedprice") * (1 - 4 * F.col("l_discount"))).select(*columns)


_K3 = ("l_quantity", "l_extendedprice", "net")


@query(sql.vif2("l_quantity", "l_extendedprice"))
def vif_matrix_k2(spark, sf_dir):
    return _rounded(V.vif(_numbers(spark, sf_dir, "l_quantity", "l_extendedprice")))


@query(sql.vif3(*_K3))
def vif_matrix_k3(spark, sf_dir):
    return _rounded(V.vif(_numbers(spark, sf_dir, *_K3)))


@query(sql.vif3(*_K3, having="WHERE \"VIF\" >= 1.5"))
def vif_threshold(spark, sf_dir):
    return _rounded(V.vif(_numbers(spark, sf_dir, *_K3), threshold=1.5))


@query(sql.vif3(*_K3))
def vif_streaming(spark, sf_dir):
    return _rounded(V.vif(_numbers(spark, sf_dir, *_K3), method="streaming"))


@query(sql.vif3(*_K3))
def vif_parallel(spark, sf_dir):
    return _rounded(V.vif(_numbers(spark, sf_dir, *_K3), method="parallel"))


@query(sql.BATCH_PLAN)
def batch_plan(spark, sf_dir):
    """Pages and candles to expect between the bounds of each series, for two timeframes."""
    c = candles(spark, sf_dir).groupBy("symbol").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    t = c.withColumn("t", F.explode(F.array(*(F.struct(F.lit(k).alias("timeframe"), F.lit(seconds(k)).alias("s")) for k in ("5m", "1h")))))
    lo, hi, s = micros(F.col("lo")), micros(F.col("hi")), F.col("t.s")
    return t.select("symbol", "t.timeframe", expected_pages_column(lo, hi, s).alias("pages"), F.floor((hi - lo) / 1_000_000 / s).cast("long").alias("candles"))


@query(sql.FEATURES_VIF)
def features_vif(spark, sf_dir):
    """Candles, gap fill, two indicators, and their factors, all of which SQL can follow."""
    filled = impute.ffill(candles(spark, sf_dir), "1h").drop("is_imputed")
    d = add_indicators(filled, [("mom", "1h", {}), ("willr", "1h", {})], "1h", ordered=False)
    return _rounded(V.vif(d.select("mom_10_1h", "willr_14_1h")))


TIMEFRAMES, PERIODS = ("5m", "15m", "30m", "1h", "2h", "6h", "1d"), (7, 14, 21, 28)
FEATURES = [
    (name, t, {"fastperiod": p, "slowperiod": 2 * p} if name == "ppo" else {"timeperiod": p})
    for name in ("adx", "atr", "ppo", "rsi") for t in TIMEFRAMES for p in PERIODS
]


@query(None)
def pipeline_features_vif(spark, sf_dir):
    """Candles, gap fill, 112 indicator requests over seven timeframes, and the factors of the features; those under 5 are worth keeping."""
    filled = impute.ffill(candles(spark, sf_dir, "5m"), "5m").drop("is_imputed")
    d = add_indicators(filled, FEATURES, "5m", ordered=False)
    return _rounded(V.vif(d.select(*(output_name(REGISTRY[n], p, t) for n, t, p in FEATURES)), method="parallel"))


@query(f"{sql.SYMBOLS} ")
def symbol_paths(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey"), F.upper(F.concat_ws("/", F.substring("p_brand", 1, 5), F.col("p_type"))).alias("symbol"))
    return p.select("p_partkey", store.symbol_path_column(F.col("symbol")).alias("path"))
