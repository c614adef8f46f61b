"""Mixing sources to target weights, by fixed-length blocks and pseudorandom index permutations.

The words of a source's documents form one stream, cut into blocks of ``BLOCK`` words. A source's target is its
share by weight of all words, held at ``REPEATS`` times its own size, the excess going to the others by weight.
Its quota is the least number of slots that hold the target, rounded to words. The mix is a row of slots in output shards; a multinomial draw by shard, seeded by
the shard's number, says how many slots each source gets there. Slot number j of a source holds block
perm(j mod n) of its n blocks, perm being a Feistel permutation keyed by seed, source and pass (j div n): so each
pass takes every block once, and no document is taken more than REPEATS times. Draws over the quota are left out and
what is short of it goes to a last shard. Of the block in a source's last slot only the first words are taken, so that all slots together hold the target.
Blocks and slots are joined by (source, block index).

The order within a stream is by (salt, doc_id, size), the salt being a hash over 4096 values: a source with a third
of all rows is summed in 4096 groups and then over group totals.

Null texts have no words; size 0 is never taken. A null source is a source, the last. Rows that repeat a doc_id are
documents of their own. An empty table gives no rows. Only sources (name, size) reach the driver, ``MAX_SOURCES`` at
most, which is checked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork.llm.common import cut, partitions, words

WEIGHTS, REPEATS, BLOCK, SHARD_SLOTS, SHARDS, SALTS, MAX_SOURCES = (5, 2, 1), 3, 64, 8192, 100_000, 4096, 100_000


def targets(sizes: list[int], weights: list[float], repeats: int = REPEATS) -> list[float]:
    """The words to take of each source: all sizes shared by weight, none above repeats times its size."""
    out, rest, free = [0.0] * len(sizes), float(sum(sizes)), [*range(len(sizes))]
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if rest * weights[i] / total > repeats * sizes[i]]
        if not over:
            for i in free:
                out[i] = rest * weights[i] / total
            break
        for i in over:
            out[i] = float(repeats * sizes[i])
            free.remove(i)
        rest = max(0.0, rest - sum(out[i] for i in over))
    return out


def _mixed(x: np.ndarray, mask: np.uint64) -> np.ndarray:
    y = x * np.uint64(0x9E3779B97F4A7C15)
    return ((y ^ (y >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)) & mask


def permuted(x: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """A pseudorandom permutation of range(n), at x, or its inverse: four Feistel rounds over the next even power of two, walked until inside."""
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = np.random.default_rng(key).integers(0, 1 << 63, 4, dtype=np.uint64)
    out, todo = x.astype(np.uint64), np.arange(len(x))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys[::-1] if inverse else keys:
            left, right = (right ^ _mixed(left + k, mask), left) if inverse else (right, left ^ _mixed(right + k, mask))
        out[todo] = left << half | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _key(seed: int, sid: int, turn: int) -> int:
    return hash((seed, sid, turn)) & (1 << 62) - 1


def quotas(size: int, goal: int, block: int, seed: int, sid: int) -> tuple[int, int, int]:
    """(slots, block of the last one, its words that are taken) of a source of that size, so that slots hold goal words."""
    if not size or not goal:
        return 0, -1, 0
    n = -(-size // block)
    short = n * block - size  # what the last block lacks

    def held(q: int) -> int:
        e, r = divmod(q, n)
        place = int(permuted(np.array([n - 1]), n, _key(seed, sid, e), inverse=True)[0]) if r else n
        return e * size + r * block - (short if place < r else 0)

    q = max(1, -(-goal * n // size))
    while held(q) < goal:
        q += 1
    while q > 1 and held(q - 1) >= goal:
        q -= 1
    last = int(permuted(np.array([(q - 1) % n]), n, _key(seed, sid, (q - 1) // n))[0])
    return q, last, goal - held(q - 1)


class Mix:
    """documents mixed to target weights; the frames are lazy but for the sizes."""

    def __init__(self, documents: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 11):
        spark, self.block, self.seed = documents.sparkSession, block, seed
        text = F.coalesce("text", F.lit(""))
        self.docs = cut(documents.select(
            "doc_id", F.col("source").cast("string"), F.size(words(text)).cast("long").alias("size"), F.xxhash64("text").alias("t"), F.monotonically_increasing_id().alias("row"),
        ))
        per = self.docs.groupBy("source").agg(F.sum("size").alias("size"))
        rows = sorted((tuple(r) for r in per.limit(MAX_SOURCES + 1).collect()), key=lambda r: (r[0] is None, (r[0] or "").encode()))
        if len(rows) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        w = [weights[i % len(weights)] for i in range(len(rows))]
        goal = targets([r[1] for r in rows], w, repeats)
        blocks = [-(-r[1] // block) for r in rows]
        lasts = [quotas(r[1], round(g), block, seed, i) for i, (r, g) in enumerate(zip(rows, goal, strict=True))]
        quota = [q for q, _, _ in lasts]
        self.blocks, self.quota, self.lasts = blocks, quota, lasts
        table = [(i, r[0], r[1], g, (q - 1) // n if q else 0, last, most) for i, (r, g, n, (q, last, most)) in enumerate(zip(rows, goal, blocks, lasts, strict=True))]
        self.sources = spark.createDataFrame(table, "sid int, name string, source_size long, target double, passes int, last_block long, last_words long")
        total = sum(quota)
        self.slots_each = max(shard_slots, -(-total // SHARDS))
        self.shards = -(-total // self.slots_each)

    def streams(self) -> DataFrame:
        """docs with sid, target and start: the place of the first word in the source's stream."""
        d = self.docs.join(self.sources, F.col("source").eqNullSafe(F.col("name"))).withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)))
        sums = d.groupBy("sid", "salt").agg(F.sum("size").alias("n"))
        before = sums.withColumn("base", F.sum("n").over(Window.partitionBy("sid").orderBy("salt")) - F.col("n")).select(F.col("sid").alias("_sid"), F.col("salt").alias("_salt"), "base")
        own = Window.partitionBy("sid", "salt").orderBy("doc_id", "size", "t", "row")
        d = d.withColumn("inner", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        return d.join(before, (F.col("sid") == F.col("_sid")) & (F.col("salt") == F.col("_salt"))).withColumn("start", F.col("base") + F.col("inner")).drop("base", "inner", "_sid", "_salt", "salt", "name")

    def draws(self) -> DataFrame:
        """(shard, sid, n, first): n slots of the source in the shard, holding its slot numbers from first on."""
        spark, shards, each, quota, seed = self.docs.sparkSession, self.shards, self.slots_each, self.quota, self.seed
        share = np.array(quota, float) / max(1, sum(quota))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for shard in f["id"]:
                    n = np.random.default_rng([seed, int(shard)]).multinomial(each, share / max(share.sum(), 1e-300))
                    yield pd.DataFrame({"shard": np.int64(shard), "sid": np.arange(len(n), dtype=np.int32), "n": n})[n > 0]

        drawn = spark.range(0, shards, 1, max(1, min(partitions(spark), shards))).mapInPandas(run, "shard long, sid int, n long")
        limit = spark.createDataFrame([(i, q) for i, q in enumerate(quota)] or [], "sid int, quota long")
        drawn = drawn.withColumn("first", F.sum("n").over(Window.partitionBy("sid").orderBy("shard")) - F.col("n")).join(limit, "sid")
        inside = drawn.withColumn("n", F.least("n", F.col("quota") - F.col("first"))).where("n > 0").select("shard", "sid", "n", "first")
        got = inside.groupBy("sid").agg(F.sum("n").alias("got"))
        short = limit.join(got, "sid", "left").select(F.lit(shards).cast("long").alias("shard"), "sid", (F.col("quota") - F.coalesce("got", F.lit(0))).alias("n"), F.coalesce("got", F.lit(0)).cast("long").alias("first")).where("n > 0")
        return inside.union(short)

    def slots(self) -> DataFrame:
        """(shard, sid, pass, block, words): what each slot of the mix holds, words being how many of the block's are taken at most."""
        blocks, lasts, size, seed = self.blocks, self.lasts, self.block, self.seed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    n, sid = blocks[r["sid"]], r["sid"]
                    for at in range(r["first"], r["first"] + r["n"], 1 << 20):
                        j = np.arange(at, min(at + (1 << 20), r["first"] + r["n"]))
                        e, found = j // n, np.empty(len(j), np.int64)
                        for x in np.unique(e):
                            found[e == x] = permuted(j[e == x] % n, n, _key(seed, sid, int(x)))
                        words = np.where(j == lasts[sid][0] - 1, lasts[sid][2], size)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), v, t)) for v, t in ((r["shard"], np.int64), (sid, np.int32))] + [pa.array(e.astype(np.int32)), pa.array(found), pa.array(words)], ["shard", "sid", "pass", "block", "words"])

        d = self.draws()
        return d.repartition(partitions(d.sparkSession), "shard", "sid").mapInArrow(run, "shard long, sid int, pass int, block long, words long")

    def taken_blocks(self, streams: DataFrame) -> DataFrame:
        """(row, lo, n, last, times, passes): the parts of documents, by word, that taken blocks hold, and how often; last of the n words the last time, if that is the source's last slot."""
        b = self.block
        parts = streams.where("size > 0").select("row", "sid", "start", "size", "passes", "last_block", "last_words", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")).alias("block"))
        lo, hi = F.greatest(F.lit(0), F.col("block") * b - F.col("start")), F.least(F.col("size"), (F.col("block") + 1) * b - F.col("start"))
        parts = parts.select("row", "sid", "block", "passes", "start", "last_block", "last_words", lo.alias("lo"), (hi - lo).alias("n"))
        left = F.col("last_words") - (F.col("start") + F.col("lo") - F.col("block") * b)
        last = F.when(F.col("block") == F.col("last_block"), F.greatest(F.lit(0), F.least(F.col("n"), left))).otherwise(F.col("n"))
        # the planner sees only the few draws that slots come from, and would broadcast what grows with the corpus
        times = self.slots().groupBy("sid", "block").agg(F.count("*").alias("times")).hint("merge")
        return parts.withColumn("last", last).join(times, ["sid", "block"]).select("row", "lo", "n", "last", "times", "passes")

    def result(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) per document."""
        s = self.streams()
        got = self.taken_blocks(s).groupBy(F.col("row").alias("_row")).agg(F.sum(F.col("n") * (F.col("times") - 1) + F.col("last")).alias("taken"))
        return s.join(got, F.col("row") == F.col("_row"), "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def documents(self, documents: DataFrame) -> DataFrame:
        """The mix as documents with all their columns: a row for each whole pass over a document, and one with the words that the last, unfinished pass takes of it."""
        s = self.streams()
        extra = self.taken_blocks(s).where("times > passes and last > 0").groupBy(F.col("row").alias("_row")).agg(F.array_sort(F.collect_list(F.struct("lo", (F.col("lo") + F.col("last")).alias("hi")))).alias("spans"))
        plan = s.join(extra, F.col("row") == F.col("_row"), "left").where((F.col("size") > 0) & ((F.col("passes") > 0) | F.col("spans").isNotNull()))
        plan = plan.groupBy("doc_id", "t").agg(F.collect_list(F.struct("passes", "size", "spans")).alias("plan")).select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"), "plan")
        boxed = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("_k"), F.xxhash64("text").alias("_x"))
        if not self.docs.groupBy("doc_id", "t").count().where("count > 1").isEmpty():
            boxed = boxed.dropDuplicates(["_k", "_x"])
        both = boxed.join(plan, F.col("_k").eqNullSafe(F.col("_id")) & (F.col("_x") == F.col("_t"))).select("row", "plan")
        names = documents.columns
        at, count = names.index("text"), names.index("n_chars") if "n_chars" in names else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                fields = b.column(0).flatten()
                for first in range(0, b.num_rows, 500):
                    rows, texts = [], []
                    for i in range(first, min(first + 500, b.num_rows)):
                        text = fields[at][i].as_py()
                        for p in b.column(1)[i].as_py():
                            rows += [i] * p["passes"]
                            texts += [text] * p["passes"]
                            if p["spans"]:
                                rows.append(i)
                                texts.append(text if sum(x["hi"] - x["lo"] for x in p["spans"]) == p["size"] else cut_out(text, [(x["lo"], x["hi"]) for x in p["spans"]]))
                    columns = [f.take(pa.array(rows, pa.int64())) for f in fields]
                    columns[at] = pa.array(texts, columns[at].type)
                    if count is not None:
                        columns[count] = pa.array([len(x) for x in texts], columns[count].type)
                    yield pa.RecordBatch.from_arrays(columns, names)

        return both.mapInArrow(run, documents.schema)


def cut_out(text: str, spans: list[tuple[int, int]]) -> str:
    """The words lo to hi of each span with what stands between them; spans that touch stay as they were, others meet with a line break."""
    found = [m.span() for m in re.finditer("[^\x20\x09-\x0d]+", text)]
    merged: list[list[int]] = []
    for lo, hi in spans:
        if merged and merged[-1][1] == lo:
            merged[-1][1] = hi
        else:
            merged.append([lo, hi])
    return "\n".join(text[found[lo][0] : found[hi - 1][1]] for lo, hi in merged)
