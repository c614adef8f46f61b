"""The SQL side of the catalogue, for DuckDB."""

from __future__ import annotations

_UNIT = {"5m": "5 minutes", "1h": "1 hour", "2h": "2 hours", "6h": "6 hours", "1d": "1 day"}


def candles(timeframe: str, name: str = "candles", recursive: bool = False) -> str:
    return f"""WITH {"RECURSIVE " if recursive else ""}{_candles(timeframe, name)}"""


def _candles(timeframe: str, name: str = "candles") -> str:
    return f"""{name} AS (SELECT event_type AS symbol, '{timeframe}' AS timeframe, time_bucket(INTERVAL '{_UNIT[timeframe]}', ts) AS timestamp,
 arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*)::DOUBLE AS volume FROM events GROUP BY ALL)"""


def filled(timeframe: str) -> str:
    unit = _UNIT[timeframe]
    last = ", ".join(f"last_value(c.{x} IGNORE NULLS) OVER w AS {x}" for x in ("open", "high", "low", "close"))
    return f"""{candles(timeframe)}, b AS (SELECT symbol, timeframe, min(timestamp) AS lo, max(timestamp) AS hi FROM candles GROUP BY ALL),
grid AS (SELECT symbol, timeframe, unnest(generate_series(lo, hi, INTERVAL '{unit}')) AS timestamp FROM b),
filled AS (SELECT g.symbol, g.timeframe, g.timestamp, {last}, coalesce(c.volume, 0) AS volume, c.timestamp IS NULL AS is_imputed
 FROM grid g LEFT JOIN candles c ON g.symbol = c.symbol AND g.timestamp = c.timestamp WINDOW w AS (PARTITION BY g.symbol ORDER BY g.timestamp))"""


_REPORT = """d AS (SELECT *, date_diff('second', lag(timestamp) OVER (PARTITION BY asset, timeframe ORDER BY timestamp), timestamp) AS s FROM u),
g AS (SELECT asset, timeframe, min(timestamp) AS range_start, max(timestamp) AS range_end, count(DISTINCT strftime(timestamp, '%Y-%m'))::BIGINT AS files_processed, count(*) AS actual, any_value(c) AS c,
 count(*) FILTER (s > c) AS gap_count, avg(s // c - 1) FILTER (s > c) AS m, min(s // c - 1) FILTER (s > c) AS shortest_gap_missing, max(s // c - 1) FILTER (s > c) AS largest_gap_missing, avg(s - c) FILTER (s > c) AS x FROM d GROUP BY ALL),
e AS (SELECT *, date_diff('second', range_start, range_end) // c + 1 AS expected FROM g)
SELECT asset, timeframe, range_start, range_end, files_processed, actual, expected, greatest(expected - actual, 0) AS missing,
 floor(actual / expected * 100) / 100 AS availability, floor(greatest(expected - actual, 0) / expected * 100) / 100 AS sparsity, gap_count, coalesce(floor(m * 100) / 100, 0) AS avg_gap_missing,
 shortest_gap_missing, largest_gap_missing, coalesce(floor(x * 100) / 100, 0) AS avg_extra_gap_seconds FROM e"""
SPARSITY = f"""WITH {_candles("1h", "a")}, {_candles("5m", "b")},
u AS (SELECT symbol || '-usd' AS asset, timeframe, timestamp, CASE timeframe WHEN '1h' THEN 3600 ELSE 300 END AS c FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE symbol IN ('click', 'view', 'error')),
{_REPORT}"""
SPARSITY_FILES = f"""WITH {_candles("1h", "a")}, {_candles("2h", "b")},
u AS (SELECT symbol || '-usd' AS asset, timeframe, timestamp, CASE timeframe WHEN '1h' THEN 3600 ELSE 7200 END AS c FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
 WHERE symbol IN ('click', 'view', 'error') AND month(timestamp) = 1 AND NOT (symbol = 'error' AND hour(timestamp) = 3)),
{_REPORT}"""


def synthetic(timeframe: str, w: int, recursive: bool = False) -> str:
    """By a join of rows with the aggregate of their last completed bucket."""
    return f"""{candles(timeframe, recursive=recursive)}, i AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS i FROM candles),
buckets AS (SELECT symbol, i // {w} AS b, max(high) AS high, min(low) AS low, arg_max(close, i) AS close FROM i GROUP BY ALL),
synthetic AS (SELECT i.symbol, i.timestamp, i.i, b.high AS high_{w}, b.low AS low_{w}, b.close AS close_{w} FROM i LEFT JOIN buckets b ON b.symbol = i.symbol AND b.b = (i.i + 1) // {w} - 1)"""


def _base(w: int, holes: str = "false") -> str:
    """x: (symbol, timestamp, i, open, high, low, close, volume), i from 0 at the first row with values; where holes holds a row has none."""
    if w == 1:
        return f"{candles('1h', recursive=True)}, x AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS i FROM candles WHERE NOT ({holes})), every_row AS (SELECT symbol, timestamp FROM candles)"
    return f"""{synthetic("1h", w, recursive=True)}, every_row AS (SELECT symbol, timestamp FROM synthetic),
x AS (SELECT symbol, timestamp, i - {w - 1} AS i, NULL AS open, high_{w} AS high, low_{w} AS low, close_{w} AS close, NULL AS volume FROM synthetic WHERE i >= {w - 1})"""


def _over(n: int | None = None, order: str = "i") -> str:
    frame = "" if n is None else f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
    return f"OVER (PARTITION BY symbol ORDER BY {order}{frame})"


def _ema(name: str, source: str, value: str, n: int, first: int) -> str:
    """CTE name(symbol, i, v): the exponential mean of a source's value, seeded by the mean of rows first to first + n - 1."""
    at = first + n - 1
    return f"""{name} AS (SELECT symbol, {at}::BIGINT AS i, v FROM (SELECT symbol, avg({value}) AS v, count(*) AS c FROM {source} WHERE i BETWEEN {first} AND {at} GROUP BY symbol) WHERE c = {n}
 UNION ALL SELECT s.symbol, s.i, r.v + (s.{value} - r.v) * (2.0::DOUBLE / {n + 1}) FROM {name} r JOIN {source} s ON s.symbol = r.symbol AND s.i = r.i + 1)"""


def _wilder_changes(n: int) -> str:
    """CTE wilder(symbol, i, g, l)."""
    return f"""ch AS (SELECT symbol, i, close - lag(close) {_over()} AS c FROM x),
wilder AS (SELECT symbol, {n}::BIGINT AS i, g, l FROM (SELECT symbol, sum(greatest(c, 0)) / {n} AS g, sum(greatest(-c, 0)) / {n} AS l, count(*) AS k FROM ch WHERE i BETWEEN 1 AND {n} GROUP BY symbol) WHERE k = {n}
 UNION ALL SELECT s.symbol, s.i, (r.g * {n - 1} + greatest(s.c, 0)) / {n}, (r.l * {n - 1} + greatest(-s.c, 0)) / {n} FROM wilder r JOIN ch s ON s.symbol = r.symbol AND s.i = r.i + 1)"""


_TR = f"""prev AS (SELECT *, lag(close) {_over()} AS pc, lag(high) {_over()} AS ph, lag(low) {_over()} AS pl FROM x),
tr AS (SELECT *, CASE WHEN i > 0 THEN greatest(high - low, abs(high - pc), abs(low - pc)) END AS t FROM prev)"""
_AD = f"""flow AS (SELECT *, CASE WHEN high > low THEN ((close - low) - (high - close)) / (high - low) * volume ELSE 0 END AS f FROM x),
ad AS (SELECT symbol, i, sum(f) {_over()} AS a FROM flow)"""


def _steps(name: str, p: dict) -> tuple[str, str, str]:
    """(CTEs on x, FROM clause that has symbol and i, output columns as 'expression AS field' with $ for a single output's name)."""
    n = int(p.get("timeperiod", 0))
    if name == "ad":
        return _AD, "ad", "a AS $"
    if name == "adosc":
        f, s = int(p["fastperiod"]), int(p["slowperiod"])
        return (
            _AD
            + f""", osc AS (SELECT symbol, i, a AS f, a AS s FROM ad WHERE i = 0
 UNION ALL SELECT d.symbol, d.i, 2.0::DOUBLE / {f + 1} * d.a + (1 - 2.0::DOUBLE / {f + 1}) * r.f, 2.0::DOUBLE / {s + 1} * d.a + (1 - 2.0::DOUBLE / {s + 1}) * r.s FROM osc r JOIN ad d ON d.symbol = r.symbol AND d.i = r.i + 1)""",
            f"(SELECT * FROM osc WHERE i >= {max(f, s) - 1})",
            "f - s AS $",
        )
    if name == "adx":
        return (
            _TR
            + f""", dm AS (SELECT symbol, i, t, CASE WHEN high - ph > 0 AND high - ph > pl - low THEN high - ph ELSE 0 END AS p, CASE WHEN pl - low > 0 AND high - ph < pl - low THEN pl - low ELSE 0 END AS m FROM tr WHERE i > 0),
sm AS (SELECT symbol, {n - 1}::BIGINT AS i, sum(t) AS t, sum(p) AS p, sum(m) AS m FROM dm WHERE i < {n} GROUP BY symbol
 UNION ALL SELECT d.symbol, d.i, r.t - r.t / {n} + d.t, r.p - r.p / {n} + d.p, r.m - r.m / {n} + d.m FROM sm r JOIN dm d ON d.symbol = r.symbol AND d.i = r.i + 1),
dx AS (SELECT symbol, i, CASE WHEN t <> 0 AND p + m <> 0 THEN 100 * abs(m - p) / (p + m) END AS d FROM sm WHERE i >= {n}),
adx AS (SELECT symbol, {2 * n - 1}::BIGINT AS i, a FROM (SELECT symbol, sum(coalesce(d, 0)) / {n} AS a, count(*) AS c FROM dx WHERE i < {2 * n} GROUP BY symbol) WHERE c = {n}
 UNION ALL SELECT d.symbol, d.i, CASE WHEN d.d IS NULL THEN r.a ELSE (r.a * {n - 1} + d.d) / {n} END FROM adx r JOIN dx d ON d.symbol = r.symbol AND d.i = r.i + 1)""",
            "adx",
            "a AS $",
        )
    if name == "aroon":
        best = lambda f, c: f"i - {f}(i, ({c}, {'i' if f == 'arg_max' else '-i'})) {_over(n + 1)}"
        return f"a AS (SELECT symbol, i, {best('arg_max', 'high')} AS u, {best('arg_min', 'low')} AS d FROM x)", f"(SELECT * FROM a WHERE i >= {n})", f"100.0 * ({n} - d) / {n} AS aroondown, 100.0 * ({n} - u) / {n} AS aroonup"
    if name == "atr":
        return (
            _TR
            + f""", atr AS (SELECT symbol, {n}::BIGINT AS i, a FROM (SELECT symbol, avg(t) AS a, count(*) AS c FROM tr WHERE i BETWEEN 1 AND {n} GROUP BY symbol) WHERE c = {n}
 UNION ALL SELECT s.symbol, s.i, (r.a * {n - 1} + s.t) / {n} FROM atr r JOIN tr s ON s.symbol = r.symbol AND s.i = r.i + 1)""",
            "atr",
            "a AS $",
        )
    if name == "bbands":
        return f"b AS (SELECT symbol, i, avg(close) {_over(n)} AS m, stddev_pop(close) {_over(n)} AS s FROM x)", f"(SELECT * FROM b WHERE i >= {n - 1})", f"m + {p['nbdevup']} * s AS upperband, m AS middleband, m - {p['nbdevdn']} * s AS lowerband"
    if name == "cci":
        return (
            f"tp AS (SELECT symbol, i, (high + low + close) / 3 AS p FROM x), w AS (SELECT symbol, i, p, avg(p) {_over(n)} AS m, list(p) {_over(n)} AS l FROM tp), c AS (SELECT *, list_sum(list_transform(l, lambda y: abs(y - m))) / {n} AS d FROM w)",
            f"(SELECT * FROM c WHERE i >= {n - 1})",
            "CASE WHEN p <> m AND d <> 0 THEN (p - m) / (0.015 * d) ELSE 0 END AS $",
        )
    if name in ("cmo", "rsi"):
        return _wilder_changes(n), "wilder", f"CASE WHEN g + l <> 0 THEN 100 * {'(g - l)' if name == 'cmo' else 'g'} / (g + l) ELSE 0 END AS $"
    if name == "kama":
        return (
            f"""d AS (SELECT symbol, i, close, abs(close - lag(close) {_over()}) AS a, close - lag(close, {n}) {_over()} AS way FROM x),
e AS (SELECT symbol, i, close, way, sum(a) {_over(n)} AS walk FROM d),
k AS (SELECT symbol, i, close, power(CASE WHEN walk <= way OR walk < 1e-14 THEN 1 ELSE abs(way / walk) END * (2.0::DOUBLE / 3 - 2.0::DOUBLE / 31) + 2.0::DOUBLE / 31, 2) AS c FROM e WHERE i >= {n}),
kama AS (SELECT symbol, {n - 1}::BIGINT AS i, close AS v FROM x WHERE i = {n - 1} UNION ALL SELECT k.symbol, k.i, r.v + (k.close - r.v) * k.c FROM kama r JOIN k ON k.symbol = r.symbol AND k.i = r.i + 1)""",
            f"(SELECT * FROM kama WHERE i >= {n})",
            "v AS $",
        )
    if name == "macd":
        f, s, g = (int(p[k]) for k in ("fastperiod", "slowperiod", "signalperiod"))
        return (
            f"{_ema('fast', 'x', 'close', f, s - f)}, {_ema('slow', 'x', 'close', s, 0)}, line AS (SELECT f.symbol, f.i, f.v - s.v AS m FROM fast f JOIN slow s ON f.symbol = s.symbol AND f.i = s.i), {_ema('sig', 'line', 'm', g, s - 1)}",
            "(SELECT l.symbol, l.i, l.m, g.v FROM line l JOIN sig g ON l.symbol = g.symbol AND l.i = g.i)",
            "m AS macd, v AS macdsignal, m - v AS macdhist",
        )
    if name == "mfi":
        return (
            f"tp AS (SELECT symbol, i, volume, (high + low + close) / 3 AS p FROM x), f AS (SELECT *, p - lag(p) {_over()} AS c, p * volume AS f FROM tp), m AS (SELECT symbol, i, sum(CASE WHEN c > 0 THEN f ELSE 0 END) {_over(n)} AS u, sum(CASE WHEN c < 0 THEN f ELSE 0 END) {_over(n)} AS d FROM f)",
            f"(SELECT * FROM m WHERE i >= {n})",
            "CASE WHEN u + d >= 1 THEN 100 * u / (u + d) ELSE 0 END AS $",
        )
    if name == "mom":
        return f"m AS (SELECT symbol, i, close - lag(close, {n}) {_over()} AS v FROM x)", "m", "v AS $"
    if name == "obv":
        return f"c AS (SELECT *, close - lag(close) {_over()} AS c FROM x), o AS (SELECT symbol, i, sum(CASE WHEN c IS NULL THEN volume ELSE sign(c) * volume END) {_over()} AS v FROM c)", "o", "v AS $"
    if name == "ppo":
        f, s = sorted((int(p["fastperiod"]), int(p["slowperiod"])))
        return f"m AS (SELECT symbol, i, avg(close) {_over(f)} AS f, avg(close) {_over(s)} AS s FROM x)", f"(SELECT * FROM m WHERE i >= {s - 1})", "CASE WHEN s <> 0 THEN 100 * (f - s) / s ELSE 0 END AS $"
    if name == "roc":
        return f"m AS (SELECT symbol, i, close, lag(close, {n}) {_over()} AS p FROM x)", "m", "CASE WHEN p IS NULL THEN NULL WHEN p <> 0 THEN 100 * (close / p - 1) ELSE 0 END AS $"
    if name == "stoch":
        a, b, c = (int(p[k]) for k in ("fastk_period", "slowk_period", "slowd_period"))
        return (
            f"r AS (SELECT symbol, i, close, min(low) {_over(a)} AS l, max(high) {_over(a)} AS h FROM x), q AS (SELECT symbol, i, CASE WHEN h <> l THEN 100 * (close - l) / (h - l) ELSE 0 END AS k FROM r WHERE i >= {a - 1}), s AS (SELECT symbol, i, avg(k) {_over(b)} AS k FROM q QUALIFY i >= {a + b - 2}), d AS (SELECT symbol, i, k, avg(k) {_over(c)} AS d FROM s QUALIFY i >= {a + b + c - 3})",
            "d",
            "k AS slowk, d AS slowd",
        )
    if name == "stochrsi":
        a, b = int(p["fastk_period"]), int(p["fastd_period"])
        return (
            _wilder_changes(n)
            + f""", rsi AS (SELECT symbol, i, CASE WHEN g + l <> 0 THEN 100 * g / (g + l) ELSE 0 END AS r FROM wilder),
q AS (SELECT symbol, i, r, min(r) {_over(a)} AS l, max(r) {_over(a)} AS h FROM rsi), k AS (SELECT symbol, i, CASE WHEN h <> l THEN 100 * (r - l) / (h - l) ELSE 0 END AS k FROM q WHERE i >= {n + a - 1}), d AS (SELECT symbol, i, k, avg(k) {_over(b)} AS d FROM k)""",
            f"(SELECT * FROM d WHERE i >= {n + a + b - 2})",
            "k AS fastk, d AS fastd",
        )
    if name == "trix":
        return f"{_ema('e1', 'x', 'close', n, 0)}, {_ema('e2', 'e1', 'v', n, n - 1)}, {_ema('e3', 'e2', 'v', n, 2 * (n - 1))}, t AS (SELECT symbol, i, v, lag(v) {_over()} AS p FROM e3)", f"(SELECT * FROM t WHERE i >= {3 * (n - 1) + 1})", "100 * (v / p - 1) AS $"
    if name == "willr":
        return f"r AS (SELECT symbol, i, close, min(low) {_over(n)} AS l, max(high) {_over(n)} AS h FROM x)", f"(SELECT * FROM r WHERE i >= {n - 1})", "CASE WHEN h <> l THEN 100 * (close - h) / (h - l) ELSE 0 END AS $"
    if name == "wma":
        return f"w AS (SELECT symbol, i, list(close) {_over(n)} AS l FROM x)", f"(SELECT * FROM w WHERE i >= {n - 1})", f"list_sum(list_transform(l, lambda y, k: y * k)) / {n * (n + 1) / 2} AS $"
    raise KeyError(name)


def indicator(name: str, column: str, w: int, params: dict, holes: str = "false") -> str:
    steps, source, out = _steps(name, params)
    out = out.replace("$", column)
    fields = [x.rsplit(" AS ", 1)[1] for x in out.split(", ") if " AS " in x]
    rounded = ", ".join(f"round(v.{f}, 6) AS {f}" for f in fields)
    return f"""{_base(w, holes)}, {steps}, v AS (SELECT symbol, i, {out} FROM {source})
SELECT e.symbol, e.timestamp, {rounded} FROM every_row e LEFT JOIN x ON x.symbol = e.symbol AND x.timestamp = e.timestamp LEFT JOIN v ON v.symbol = x.symbol AND v.i = x.i"""


_SYN = ", ".join(
    f"c{w} AS (SELECT symbol, i.i AS i, b.close AS c{w} FROM i LEFT JOIN (SELECT symbol AS s, i // {w} AS b, arg_max(close, i) AS close FROM i GROUP BY ALL) b ON b.s = i.symbol AND b.b = (i.i + 1) // {w} - 1)" for w in (2, 6)
)
FETCHED = """WITH r(timeframe, s, lo, hi) AS (VALUES ('5m', 300, TIMESTAMP '2024-01-01 00:30:00', TIMESTAMP '2024-01-03 12:10:00'), ('1h', 3600, TIMESTAMP '2024-01-01 01:00:00', TIMESTAMP '2024-01-03 12:00:00')),
c AS (SELECT timeframe, s, unnest(generate_series(lo, hi, to_seconds(s))) AS timestamp FROM r), n AS (SELECT *, epoch(timestamp)::BIGINT // s AS n FROM c)
SELECT unnest(['AAA/USD', 'CCC/USD']) AS symbol, timeframe, timestamp, (n % 97)::DOUBLE AS open, (n % 97 + 2)::DOUBLE AS high, (n % 97 - 1)::DOUBLE AS low, (n % 97 + 1)::DOUBLE AS close, (n % 13)::DOUBLE AS volume FROM n"""
_RULE = "(n % 97)::DOUBLE AS open, (n % 97 + 2)::DOUBLE AS high, (n % 97 - 1)::DOUBLE AS low, (n % 97 + 1)::DOUBLE AS close, (n % 13)::DOUBLE AS volume"


def fetched(lo: str, hi: str, symbols: tuple[str, ...], timeframes: tuple[str, ...], stored: bool = False) -> str:
    """What the rule of the sample exchange gives between the bounds."""
    step = "CASE timeframe WHEN '1h' THEN 3600 ELSE 300 END"
    names = ", ".join(f"'{s.replace('/', '-').lower() if stored else s}'" for s in symbols)
    return f"""WITH t AS (SELECT unnest([{", ".join(f"'{t}'" for t in timeframes)}]) AS timeframe), c AS (SELECT timeframe, {step} AS s, unnest(generate_series({lo}, {hi} + CASE timeframe WHEN '5m' THEN INTERVAL 55 minutes ELSE INTERVAL 0 minutes END, to_seconds({step}))) AS timestamp FROM t),
n AS (SELECT timeframe, timestamp, epoch(timestamp)::BIGINT // s AS n FROM c) SELECT unnest([{names}]) AS symbol, timeframe, timestamp, {_RULE} FROM n"""


TIMEFRAMES = """WITH t(timeframe, minutes) AS (VALUES ('1m', 1), ('5m', 5), ('15m', 15), ('30m', 30), ('1h', 60), ('2h', 120), ('6h', 360), ('1d', 1440), ('7m', NULL))
SELECT a.timeframe, a.minutes::BIGINT AS minutes, b.timeframe AS base, coalesce(a.minutes % b.minutes = 0, false) AS is_base, CASE WHEN a.minutes % b.minutes = 0 THEN a.minutes // b.minutes END::BIGINT AS ratio FROM t a, t b"""
LATEST = f"""WITH n AS (SELECT timeframe, s, unnest(range(1706745600 // s - 40, 1706745600 // s)) AS n FROM (VALUES ('5m', 300), ('1h', 3600)) t(timeframe, s)), c AS (SELECT timeframe, n, TIMESTAMP '1970-01-01' + to_seconds(n * s) AS timestamp FROM n)
SELECT 'AAA/USD' AS symbol, timeframe, timestamp, {_RULE} FROM c WHERE timeframe = '5m' OR hour(timestamp) % 2 = 1"""
UPDATED = f"""WITH n AS (SELECT unnest(range(epoch(TIMESTAMP '2024-01-29')::BIGINT // 3600, 1706745600 // 3600)) AS n), c AS (SELECT n, TIMESTAMP '1970-01-01' + to_seconds(n * 3600) AS timestamp FROM n), p AS (SELECT timestamp, {_RULE} FROM c)
SELECT 'aaa-usd' AS symbol, '1h' AS timeframe, timestamp, open, high, low, CASE WHEN timestamp <= TIMESTAMP '2024-01-30 12:00:00' THEN 0 ELSE close END AS close, volume FROM p"""
BATCH = f"""{candles("1h")}, i AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS i FROM candles), {_SYN},
a AS (SELECT symbol, timestamp, i, close - lag(close, 10) {_over()} AS mom, close / lag(close, 5) {_over()} - 1 AS roc, close, min(low) {_over(14)} AS l, max(high) {_over(14)} AS h, avg(close) {_over(20)} AS m, stddev_pop(close) {_over(20)} AS s FROM i),
m AS (SELECT symbol, i, CASE WHEN i >= 8 THEN c6 - lag(c6, 3) {_over()} END AS v FROM c6),
w AS (SELECT symbol, i, CASE WHEN i >= 8 THEN list_sum(list_transform(list(c2) {_over(8)}, lambda y, k: y * k)) / 36.0 END AS v FROM c2)
SELECT a.symbol, a.timestamp, round(mom, 6) AS mom_10_1h, round(100 * roc, 6) AS roc_5_1h, CASE WHEN a.i >= 13 THEN round(CASE WHEN h <> l THEN 100 * (close - h) / (h - l) ELSE 0 END, 6) END AS willr_14_1h,
 round(m.v, 6) AS mom_3_6h, round(w.v, 6) AS wma_8_2h, CASE WHEN a.i >= 19 THEN round(a.m + 2.0 * a.s, 6) END AS upperband
FROM a JOIN m ON m.symbol = a.symbol AND m.i = a.i JOIN w ON w.symbol = a.symbol AND w.i = a.i"""


def vif2(a: str, b: str) -> str:
    return f"SELECT unnest(['{a}', '{b}']) AS feature, round(1 / (1 - power(corr({a}, {b}), 2)), 6) AS \"VIF\" FROM lineitem"


def vif3(a: str, b: str, c: str, having: str = "") -> str:
    """Cofactors of the correlation matrix over its determinant."""
    return f"""WITH r AS (SELECT corr({a}, {b}) AS x, corr({a}, {c}) AS y, corr({b}, {c}) AS z FROM (SELECT *, l_extendedprice * (1 - 4 * l_discount) AS net FROM lineitem)), d AS (SELECT *, 1 + 2 * x * y * z - x * x - y * y - z * z AS d FROM r),
v AS (SELECT '{a}' AS feature, round((1 - z * z) / d, 6) AS "VIF" FROM d UNION ALL SELECT '{b}', round((1 - y * y) / d, 6) FROM d UNION ALL SELECT '{c}', round((1 - x * x) / d, 6) FROM d)
SELECT * FROM v {having}"""


FEATURES_VIF = f"""{filled("1h")}, i AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS i FROM filled),
f AS (SELECT i, close - lag(close, 10) {_over()} AS m, close, min(low) {_over(14)} AS l, max(high) {_over(14)} AS h FROM i),
g AS (SELECT m, CASE WHEN h <> l THEN 100 * (close - h) / (h - l) ELSE 0 END AS w FROM f WHERE i >= 13)
SELECT unnest(['mom_10_1h', 'willr_14_1h']) AS feature, round(1 / (1 - power(corr(m, w), 2)), 6) AS "VIF" FROM g"""
BATCH_PLAN = f"""{candles("1h")}, b AS (SELECT symbol, date_diff('second', min(timestamp), max(timestamp)) AS s FROM candles GROUP BY symbol), t AS (SELECT unnest(['5m', '1h']) AS timeframe, unnest([300, 3600]) AS c)
SELECT symbol, timeframe, greatest(1, ceil(s / (c * 300)))::BIGINT AS pages, (s // c)::BIGINT AS candles FROM b, t"""
SYMBOLS = "SELECT p_partkey, lower(replace(upper(p_brand[1:5] || '/' || p_type), '/', '-')) AS path FROM part"
