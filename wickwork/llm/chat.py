"""Chat formatting of maximal conversations.

A conversation that is logged after each turn appears as a series of growing snapshots. A turn's prefix hash covers it and
all turns before it; a conversation whose last prefix hash is an inner prefix of another one is a snapshot of that and goes, by an
anti-join. Of equal conversations the one with the smallest conv_id stays. What remains is rendered.

Prefix hashes are the xor of hashes of (position, role, text), two of 64 bits each, so they add up over chunks: they are first
made within chunks of ``CHUNK`` positions, then carried over the chunks of a conversation. Positions are found in the same way: turns that are equal in all are one row with a count, rows are
dealt by ranges of (conv_id, turn, role, text), and counts are carried over the ranges. So a conversation with a third of all turns
is many groups, never one, even if its turn numbers are all the same, or null. For the same reason a rendered conversation comes in parts of ``PART`` turns, all but the last being full;
usual conversations have one part. Turns with positions, and prefix hashes, are each computed once and kept in the shared folder.

Turns are ordered by turn (null first), then role, then text; repeated turns stay. Null roles and texts count as empty. Rows without
conv_id are one conversation. An empty table gives no rows. Extra columns are ignored.
Everything is a DataFrame expression: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wickwork.llm.common import keep, partitions

CHUNK, PART = 256, 1024


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def positions(conversations: DataFrame) -> DataFrame:
    """(conv_id, c, j, role, text, x, y): turns with their chunk, their position from 1, and two hashes of both."""
    t = conversations.select("conv_id", F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ("turn", "role", "text")
    t = t.groupBy("conv_id", *order).agg(F.count("*").alias("n"))
    t = keep(t.repartitionByRange(partitions(t.sparkSession), "conv_id", *order).withColumn("r", F.spark_partition_id()))
    counts = t.groupBy("conv_id", "r").agg(F.sum("n").alias("n"))
    counts = counts.select(F.col("conv_id").alias("_id"), F.col("r").alias("_r"), F.coalesce(F.sum("n").over(_before("r")), F.lit(0)).alias("skip"))
    inner = Window.partitionBy("conv_id", "r").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("k", F.sum("n").over(inner)).join(counts.hint("merge"), _same("conv_id", "_id") & (F.col("r") == F.col("_r")))
    last = F.col("k") + F.col("skip")
    t = t.select("conv_id", "role", "text", F.explode(F.sequence(last - F.col("n") + 1, last)).alias("j"))
    return t.select("conv_id", F.expr(f"(j - 1) div {CHUNK}").alias("c"), "j", "role", "text", F.xxhash64("j", "role", "text").alias("x"), F.xxhash64(F.lit("second"), "text", "j", "role").alias("y"))


def _before(chunk: str = "c") -> WindowSpec:
    return Window.partitionBy("conv_id").orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, j, p, q): the two prefix hashes of each turn; turns as of positions."""
    zero = F.lit(0).cast("long")
    sums = turns.groupBy("conv_id", "c").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    sums = sums.select(F.col("conv_id").alias("_id"), F.col("c").alias("_c"), F.coalesce(F.bit_xor("x").over(_before()), zero).alias("px"), F.coalesce(F.bit_xor("y").over(_before()), zero).alias("py"))
    own = Window.partitionBy("conv_id", "c").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    t = turns.select("conv_id", "c", "j", F.bit_xor("x").over(own).alias("x"), F.bit_xor("y").over(own).alias("y"))
    t = t.join(sums.hint("merge"), _same("conv_id", "_id") & (F.col("c") == F.col("_c")))
    return t.select("conv_id", "j", F.col("x").bitwiseXOR(F.col("px")).alias("p"), F.col("y").bitwiseXOR(F.col("py")).alias("q"))


def maximal(slim: DataFrame) -> DataFrame:
    """(id, n): the conversations that stay and their numbers of turns; slim as of prefixes."""
    last = slim.groupBy("conv_id").agg(F.max(F.struct("j", "p", "q")).alias("e")).select(F.col("conv_id").alias("id"), F.col("e.j").alias("n"), F.col("e.p").alias("ep"), F.col("e.q").alias("eq"))
    inner = slim.join(last, _same("conv_id", "id")).where("j < n").select("j", "p", "q").distinct()
    one = last.groupBy("n", "ep", "eq").agg(F.min("id").alias("id"))
    return one.join(inner, (F.col("n") == F.col("j")) & (F.col("ep") == F.col("p")) & (F.col("eq") == F.col("q")), "left_anti").select("id", "n")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def format_chats(conversations: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, part, n_turns, text): the maximal conversations, rendered."""
    turns = keep(positions(conversations))
    kept = turns.join(maximal(keep(prefixes(turns))), _same("conv_id", "id"))
    kept = kept.withColumn("part", F.floor((F.col("j") - 1) / part))
    d = kept.groupBy("conv_id", "part").agg(F.max("n").cast("long").alias("n_turns"), F.sort_array(F.collect_list(F.struct("j", render(F.col("role"), F.col("text")).alias("s")))).alias("a"))
    return d.select("conv_id", "part", "n_turns", F.array_join(F.transform("a", lambda x: x["s"]), "").alias("text"))


#: DuckDB SQL for format_chats(conversations).
SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS j, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, list((role, text) ORDER BY j) AS l, count(*) AS n FROM t GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, l, n FROM c GROUP BY l, n),
m AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.n > u.n AND b.l[1:u.n] = u.l))
SELECT t.conv_id, ((j - 1) // {PART})::BIGINT AS part, m.n::BIGINT AS n_turns, string_agg('<|' || role || '|>' || E'\\n' || text || '<|end|>' || E'\\n', '' ORDER BY j) AS text
FROM t JOIN m ON t.conv_id IS NOT DISTINCT FROM m.conv_id GROUP BY t.conv_id, (j - 1) // {PART}, m.n
"""
