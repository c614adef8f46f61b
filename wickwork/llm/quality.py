"""Quality rules: cross-document line frequency after per-document base rules.

Lines are normalised (lower case, digits as 0, white space as spaces, trimmed) and hashed; empty ones are left out. Documents are counted per host,
each text once: a text that is copied a thousand times is one document. A line that stands in more than ``min_docs`` documents of its host is frequent. A document
speaks against its frequent lines if the rest of it, its own lines, makes up ``keep_tenths`` tenths of its characters at least, so that it would live on without
them. A frequent line is boilerplate if more than ``min_docs`` documents, and more than ``share`` of the host's, speak against it, and these are a third at least
of all that hold it. So a menu goes from a thousand different articles, however often some of them are copied, while documents that differ in a few
lines only (near copies) have nothing of their own to speak with, and keep their lines.
Boilerplate lines are removed; a document of whose normalised characters less than ``keep_tenths`` tenths remain is
depleted and rejected.

Limits: repeated sentences of prose come up in up to 10 documents of a host now and then; in tables of 10,000 and 51,282 documents, 313 and 1,038 lines stand in
more than 5, 145 and 581 in more than 10, 30 and 284 in more than 20 documents with words of their own. More than 10, and half a percent of the host's documents,
leaves 145 and 509 lines, without which 6 and 161 documents are depleted.

Null texts have no words and fail the base rules. A null host is a host of its own. Repeated rows are one document, and
rows that agree in host and text get the same verdict, whatever their doc_id. Empty tables give empty results. Extra columns
are ignored here and kept by ``filter_documents``.
Everything is a DataFrame expression: no Python runs on the executors. Documents are read twice, once for the counts and once for the table of lines, which is
kept in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork.llm.common import SPACES, keep, redealt, release, spaced, words

MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
MIN_DOCS, SHARE, KEEP_TENTHS = 10, 0.005, 3
SYMBOLS = "#*$%&|<>"


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def base_stats(docs: DataFrame) -> DataFrame:
    """docs (with a text column that isn't null) plus the per-document counts. Nothing is shuffled.

    A filter on the counts must also name ``_stay``: its column isn't deterministic, which keeps the filter above the
    projections; pushed below, it would compute all of them again inside its predicate.
    Repeated windows are found per row by sorting (hash, position) pairs, and only for texts that have any.
    """
    d = docs.withColumn("_w", words(F.col("text")))
    d = d.withColumns({"n_words": F.size("_w").cast("long"), "_h": F.transform("_w", lambda w: F.xxhash64(w))}).drop("_w")
    window = lambda i: F.xxhash64(*(F.get("_h", i + k) for k in range(WINDOW)))
    d = d.withColumn("_v", F.when(F.size("_h") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW), window))).drop("_h")
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_v")) < F.size("_v"), F.sort_array(F.transform("_v", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_v")
    same = lambda x, k: (F.get("_s", k - 1)["h"] == x["h"]) | (F.get("_s", k + 1)["h"] == x["h"])
    d = d.withColumn("_p", F.sort_array(F.transform(F.filter("_s", same), lambda x: x["i"]))).drop("_s")
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    d = d.withColumn("_l", lines)
    return d.withColumns({
        "word_chars": F.length(_without(F.col("text"), SPACES)).cast("long"),
        "n_symbols": (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "_stay": F.monotonically_increasing_id(),
    }).drop("_l", "_p")


def failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def normal(text: Column) -> Column:
    """A text, or a line of it, normalised but for trimming."""
    text = spaced(F.lower(text), but="\n")
    for c in "123456789":
        text = F.replace(text, F.lit(c), F.lit("0"))
    return text


def _hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


KEY = ("_g", "_t")


def _keyed(documents: DataFrame, host: str) -> DataFrame:
    """documents as doc_id, text, and two hashes: _g of the host, _t of the text."""
    text = F.coalesce("text", F.lit(""))
    at = F.col(host).cast("string")
    return documents.select("doc_id", text.alias("text"), F.xxhash64(at.isNull(), at).alias("_g"), F.xxhash64(text).alias("_t"))


def line_table(keyed: DataFrame) -> DataFrame:
    """(_g, _t, h, n, rows), kept: for each text of a host its lines with their hash h, n being the characters of equal lines, summed over all rows that hold the text.
    The row whose h is null stands for the text: n is then the characters of all lines, and rows the number of its rows.

    Arrays are exploded with their empty ones: for a plain explode the optimizer filters by the array's size in the scan, which would
    compute the lines twice.
    """
    lines = F.transform(F.split(normal(F.col("text")), "\n"), lambda x: F.struct(_hash(x).alias("h"), F.length(F.trim(x)).alias("n")))
    d = keyed.select(*KEY, F.filter(lines, lambda x: x["n"] > 0).alias("lines"))
    whole = F.struct(F.lit(None).cast("long").alias("h"), F.aggregate("lines", F.lit(0), lambda a, x: a + x["n"]).alias("n"))
    d = d.select(*KEY, F.explode_outer(F.array_append("lines", whole)).alias("line"))
    return keep(d.select(*KEY, "line.h", "line.n").groupBy(*KEY, "h").agg(F.sum("n").alias("n"), F.count("*").alias("rows")))


def _on(*pairs: tuple[str, str]) -> Column:
    out = F.lit(True)
    for a, b in pairs:
        out = out & (F.col(a) == F.col(b))
    return out


def removed_lines(documents: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE, keep_tenths: int = KEEP_TENTHS) -> DataFrame:
    """(_h, _u, bad, removed, total): of texts with boilerplate, by the hashes of host and text, its hashes and characters, each line as often as it stands there, and the characters of all lines."""
    table = line_table(_keyed(documents, host))
    lines, texts = table.where("h is not null"), table.where("h is null").select(F.col("_g").alias("_h"), F.col("_t").alias("_u"), F.col("n").alias("total"), F.col("rows").alias("copies"))
    often = lines.groupBy("_g", "h").agg(F.count("*").alias("n")).where(F.col("n") > min_docs).select(F.col("_g").alias("_h"), redealt(F.col("h")).alias("_k"))
    hit = keep(lines.join(often, _on(("_g", "_h"), ("h", "_k"))).select("_g", "_t", "h", "n"))
    own = hit.groupBy(*KEY).agg(F.sum("n").alias("often")).join(texts, _on(("_g", "_h"), ("_t", "_u"))).select("_h", "_u", "total", "copies", _enough(keep_tenths, "often").alias("speaks"))
    own = keep(own)
    per = hit.join(own, _on(("_g", "_h"), ("_t", "_u"))).groupBy("_g", "h").agg(F.count("*").alias("n"), F.count_if("speaks").alias("against"))
    hosts = texts.groupBy(F.col("_h").alias("_i")).agg(F.count("*").alias("docs"))
    bad = per.where((F.col("against") > min_docs) & (3 * F.col("against") >= F.col("n"))).join(hosts, F.col("_g") == F.col("_i")).where(F.col("against") > share * F.col("docs"))
    bad = bad.select(F.col("_g").alias("_i"), redealt(F.col("h")).alias("_k"))
    gone = hit.join(bad, _on(("_g", "_i"), ("h", "_k"))).groupBy(*KEY).agg(F.collect_set("h").alias("bad"), F.sum("n").alias("removed"))
    gone = gone.join(own, _on(("_g", "_h"), ("_t", "_u")))
    whole = lambda c: F.expr(f"{c} div copies").alias(c)
    gone = keep(gone.select("_h", "_u", "bad", whole("removed"), whole("total")))
    for used in (table, hit, own):
        release(used)
    return gone


def _enough(keep_tenths: int, removed: str = "removed") -> Column:
    return 10 * (F.col("total") - F.col(removed)) >= keep_tenths * F.col("total")


def judge(documents: DataFrame, host: str = "source", keep_tenths: int = KEEP_TENTHS, **limits) -> DataFrame:
    """One row per document: the base counts, base_failed, n_removed_chars and kept."""
    stats = base_stats(_keyed(documents, host)).drop("text").withColumn("base_failed", failed())
    d = stats.join(removed_lines(documents, host, keep_tenths=keep_tenths, **limits), _on(("_g", "_h"), ("_t", "_u")), "left")
    removed = F.coalesce("removed", F.lit(0)).cast("long")
    left = F.coalesce(_enough(keep_tenths), F.lit(True))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        removed.alias("n_removed_chars"), (~F.col("base_failed") & left).alias("kept"),
    )


def filter_documents(documents: DataFrame, host: str = "source", keep_tenths: int = KEEP_TENTHS, **limits) -> DataFrame:
    """The documents that are kept, all columns, without their boilerplate lines; n_chars, where there is one, follows."""
    text, at = F.coalesce("text", F.lit("")), F.col(host).cast("string")
    d = documents.select(F.struct("*").alias("row"), text.alias("text"), F.xxhash64(at.isNull(), at).alias("_g"))
    d = base_stats(d).where(~failed() & (F.col("_stay") >= 0)).select("row", "_g", F.xxhash64("text").alias("_t"))
    d = d.join(removed_lines(documents, host, keep_tenths=keep_tenths, **limits), _on(("_g", "_h"), ("_t", "_u")), "left")
    d = d.where(F.coalesce(_enough(keep_tenths), F.lit(True)))
    kept = F.array_join(F.filter(F.split(F.col("row")["text"], "\n"), lambda x: ~F.array_contains("bad", _hash(normal(x)))), "\n")
    new = {"text": F.when(F.col("bad").isNull(), F.col("row")["text"]).otherwise(kept)}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(F.col("bad").isNull(), F.col("row")["n_chars"]).otherwise(F.length(kept).cast(documents.schema["n_chars"].dataType))
    return d.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in documents.columns))


#: DuckDB SQL for judge(documents) with its defaults.
SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
k AS (SELECT DISTINCT text FROM d),
w AS (SELECT text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM k),
g AS (SELECT text, i, words[i:i + 4] AS g FROM (SELECT text, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
rep AS (SELECT text, i FROM (SELECT *, count(*) OVER (PARTITION BY text, g) AS c FROM g) WHERE c > 1),
cov AS (SELECT text, count(DISTINCT i + j) AS n FROM rep, (SELECT unnest(range(5)) AS j) GROUP BY text),
l AS (SELECT text, unnest(string_split(text, E'\n')) AS l FROM k),
s AS (SELECT text, count(*) - count(DISTINCT l) AS n FROM l WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY text),
nl AS (SELECT text, trim(regexp_replace(regexp_replace(lower(l), '[\x09\x0B-\x0D]', ' ', 'g'), '[1-9]', '0', 'g')) AS t FROM l),
line AS (SELECT text, t, sum(length(t)) AS n FROM nl WHERE t <> '' GROUP BY ALL),
tot AS (SELECT text, sum(n) AS total FROM line GROUP BY text),
kt AS (SELECT DISTINCT source, text FROM d),
own AS (SELECT kt.source, line.* FROM kt JOIN line ON kt.text = line.text),
often AS (SELECT source, t FROM own GROUP BY ALL HAVING count(*) > 10),
hit AS (SELECT own.* FROM own JOIN often o ON own.t = o.t AND own.source IS NOT DISTINCT FROM o.source),
often_n AS (SELECT source, text, sum(n) AS n FROM hit GROUP BY ALL),
speaks AS (SELECT f.source, f.text, 10 * (total - n) >= 3 * total AS speaks FROM often_n f JOIN tot ON f.text = tot.text),
per AS (SELECT hit.source, hit.t, count(*) AS n, count(*) FILTER (speaks) AS against FROM hit JOIN speaks s ON hit.text = s.text AND hit.source IS NOT DISTINCT FROM s.source GROUP BY ALL),
h AS (SELECT source, count(*) AS docs FROM kt GROUP BY source),
bad AS (SELECT per.source, per.t FROM per JOIN h ON per.source IS NOT DISTINCT FROM h.source WHERE against > 10 AND 3 * against >= n AND against > 0.005 * docs),
gone AS (SELECT hit.source, hit.text, sum(hit.n) AS n FROM hit JOIN bad ON hit.t = bad.t AND hit.source IS NOT DISTINCT FROM bad.source GROUP BY ALL),
o AS (SELECT d.doc_id, len(w.words)::BIGINT AS n_words, length(array_to_string(w.words, ''))::BIGINT AS word_chars,
  length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(s.n, 0)::BIGINT AS n_dup_lines,
  coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_removed_chars, coalesce(tot.total, 0)::BIGINT AS total
  FROM d JOIN w ON d.text = w.text LEFT JOIN s ON d.text = s.text LEFT JOIN cov ON d.text = cov.text LEFT JOIN tot ON d.text = tot.text
  LEFT JOIN gone ON d.text = gone.text AND d.source IS NOT DISTINCT FROM gone.source)
SELECT * EXCLUDE total, base_failed IS FALSE AND 10 * (total - n_removed_chars) >= 3 * total AS kept
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM o)
"""


def with_menus(documents: DataFrame) -> DataFrame:
    """documents, of whose texts most have a menu line and some little else: a table on which lines and documents go."""
    text, host = F.coalesce("text", F.lit("")), F.coalesce("source", F.lit("all"))
    menu = F.concat(F.lit("Home | News of "), host, F.lit(" | Contact 17\n"))
    legal = F.concat(F.lit("All rights are reserved by "), host, F.lit(", whose terms hold on each of these pages\n"))
    made = F.when(F.col("doc_id") % 10 < 4, F.concat(menu, text)).when(F.col("doc_id") % 10 < 8, F.concat(menu, legal, text))
    made = made.when(F.col("doc_id") % 10 == 8, F.concat(menu, legal, F.substring_index(text, " ", 6))).otherwise(text)
    return documents.withColumn("text", made)


_MENU = "'Home | News of ' || coalesce(source, 'all') || E' | Contact 17\\n'"
_LEGAL = "'All rights are reserved by ' || coalesce(source, 'all') || E', whose terms hold on each of these pages\\n'"
#: DuckDB SQL for judge(with_menus(documents)).
SQL_MENUS = SQL.replace(
    "SELECT doc_id, source, coalesce(text, '') AS text FROM documents",
    f"SELECT doc_id, source, CASE WHEN doc_id % 10 < 4 THEN {_MENU} || t WHEN doc_id % 10 < 8 THEN {_MENU} || {_LEGAL} || t WHEN doc_id % 10 = 8 THEN {_MENU} || {_LEGAL} || array_to_string(string_split(t, ' ')[1:6], ' ') ELSE t END AS text FROM (SELECT *, coalesce(text, '') AS t FROM documents)",
)
