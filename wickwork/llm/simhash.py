"""SimHash near-duplicates, searched with vantage-point trees.

A fingerprint holds a bit where more than half of a text's shingle hashes hold it. Fingerprints that differ in at
most ``radius`` bits are linked; a document's component is named by its smallest doc_id.

Equal fingerprints are one node, so copies cost one row each and no pairs. A vantage-point tree, fitted on a bounded
sample of nodes (``SAMPLE``), splits the space of fingerprints into shards: at a vantage v with threshold t, the
inner child takes distances up to t + radius, the outer one those over t. By the triangle inequality, of two
fingerprints within the radius both are in the inner child or both in the outer one, so every link lies whole in
some shard: the overlap makes the search exact whatever the sample was. A shard that no vantage splits (a dense ball
of near copies) is salted: its nodes get one of g salts, and each pair of salts is a task of its own. Inside a
task the same pruning goes on down to blocks that are compared whole. A task returns a spanning forest of its links,
never all pairs, and a distributed star contraction joins the forests.

For near copies at a given Jaccard similarity of their sets of shingles (``similar``, ``keep_one``) the tree gives the first candidates: all texts' fingerprints go through it, and texts of equal or linked
ones are tested on their whole sets. What fingerprints that differ in more bits leave apart, and links that fail the test, is the part of an exact join by prefix filter: with each set sorted by how many texts hold a shingle, two sets can reach
the similarity s only if they share one of the first n - ceil(s n) + 1 of their n shingles, and enough of them are left from the first shared one on. Shingles of a single text come first in
that order and are never keys, so a text with too few others has no near copies and is left out. That is found out in two steps: shingles whose hashes fall into
``LOW`` 256ths of all values are counted first, and only texts that can still have enough shared ones send the others. Each candidate pair is tested on the whole sets.
The join takes only keys whose texts the passes before it left in several components. It runs twice, so that a large group of near copies makes no pairs of all with all: first each key's texts with two of them, the one with the smallest share of
shingles of its own, which is the likeliest to be near the others, and one by lot; then,
between the components that this gives, all that is left: whatever two texts of a key are not connected yet is compared.
Joins whose sides grow with the corpus are by merge; none is broadcast.

Null and empty texts have fingerprint zero, linked like any other; as sets of shingles they are equal. A null doc_id takes part; components name the
smallest id that is not null. Rows repeat in the result as they do in the input. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickwork.llm.common import SPACES, cut, keep, redealt, release

#: Fingerprints that the tree is fitted on, at most about this many; all are routed through it.
SAMPLE = 200_000
LEAF, LARGEST_LEAF, BLOCK = 4096, 65_536, 512
LOW = 104
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    return _bits(*_shingles(text, shingle))


def _shingles(text: str | None, shingle: int) -> tuple[bytes, list[int], list[int]]:
    """The text normalised, with from and to of its shingles."""
    raw = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not raw:
        return raw, [], []
    gaps = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(raw)]
    if len(starts) < shingle:
        ends = [len(raw)]
        starts = starts[:1]
    else:
        ends = ends[shingle - 1 :]
    return raw, starts[: len(ends)], ends


def _bits(raw: bytes, starts: list[int], ends: list[int]) -> int:
    import xxhash

    if not ends:
        return 0
    of = xxhash.xxh64_intdigest
    counts, step = np.zeros(2048, np.int64), 1 << 16
    for at in range(0, len(ends), step):
        hashes = np.array([of(raw[a:b], 42) for a, b in zip(starts[at : at + step], ends[at : at + step], strict=False)], np.uint64)
        columns = hashes.view(np.uint8).reshape(-1, 8) + (np.arange(8) << 8)
        counts += np.bincount(columns.ravel(), minlength=2048)
    ones = (counts.reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, t, fp): fp as a signed long, t the hash that tells texts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.fromiter((fingerprint(x.as_py(), shingle) for x in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found.view(np.int64))], ["doc_id", "t", "fp"])

    rows = documents.select("doc_id", F.xxhash64("text").alias("t"), F.col("text").cast("string"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, t long, fp long")


class Tree:
    """A vantage-point tree over 64-bit fingerprints whose children overlap by the radius."""

    def __init__(self, sample: np.ndarray, total: int, radius: int = 2, leaf: int = LEAF, seed: int = 7):
        self.radius, self.nodes, self.shards = radius, [], 0
        self.scale, self.leaf, self.rng = total / max(1, len(sample)), leaf, np.random.default_rng(seed)
        self.root = self._grow(sample)

    def _grow(self, s: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        expected = len(s) * self.scale
        split = self._split(s) if expected > self.leaf and len(s) >= 32 else None
        if split is None:
            salts = int(np.ceil(expected / LARGEST_LEAF)) if expected > LARGEST_LEAF else 1
            self.nodes[at] = ("leaf", self.shards, salts)
            self.shards += salts * salts
        else:
            v, t, d = split
            self.nodes[at] = ("split", v, t, self._grow(s[d <= t + self.radius]), self._grow(s[d > t]))
        return at

    def _split(self, s: np.ndarray):
        best = None
        for v in s[self.rng.integers(0, len(s), 8)]:
            d = np.bitwise_count(s ^ v)
            under = np.cumsum(np.bincount(d, minlength=65 + self.radius + 1))
            t = np.arange(0, 64 - self.radius)
            inner, outer = under[t + self.radius], len(s) - under[t]
            larger = np.maximum(inner, outer)
            k = int(np.argmin(larger + (inner + outer) / 4))
            if larger[k] <= 0.85 * len(s) and (best is None or inner[k] + outer[k] < best[0]):
                best = (inner[k] + outer[k], v, int(t[k]), d)
        return best and best[1:]

    def route(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(shard, index into fps) arrays: each fingerprint in every shard where a link of it can lie."""
        todo = [(self.root, np.arange(len(fps)))]
        while todo:
            at, rows = todo.pop()
            if not len(rows):
                continue
            node = self.nodes[at]
            if node[0] == "split":
                d = np.bitwise_count(fps[rows] ^ node[1])
                todo += [(node[3], rows[d <= node[2] + self.radius]), (node[4], rows[d > node[2]])]
                continue
            _, base, g = node
            own = (fps[rows] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(g)
            for other in range(g):
                lo, hi = np.minimum(own, other), np.maximum(own, other)
                yield base + (lo * g + hi).astype(np.int64), rows


def _forest(s: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (index, index) that connect what links of at most radius bits connect in s, whose values differ."""
    edges: list[tuple[int, int]] = []

    def block(rows: np.ndarray) -> None:
        near = np.bitwise_count(s[rows][:, None] ^ s[rows][None, :]) <= radius
        if np.count_nonzero(near) == len(rows):
            return
        own, many = np.arange(len(rows)), len(rows)
        while True:
            new = np.where(near, own[None, :], many).min(axis=1)
            new = new[new]
            if (new == own).all():
                break
            own = new
        edges.extend((int(a), int(b)) for a, b in zip(rows[own], rows, strict=True) if a != b)

    def search(rows: np.ndarray) -> None:
        while len(rows) > 2 * BLOCK:
            d = np.bitwise_count(s[rows] ^ s[rows[len(rows) // 2]])
            t = int(np.median(d)) - 1
            inner, outer = rows[d <= t + radius], rows[d > t]
            if max(len(inner), len(outer)) > 0.9 * len(rows):
                parts = [rows[i : i + BLOCK] for i in range(0, len(rows), BLOCK)]
                for i, a in enumerate(parts):
                    for b in parts[i + 1 :] or parts[:0]:
                        block(np.concatenate([a, b]))
                return
            search(inner)
            rows = outer
        block(rows)

    search(np.arange(len(s)))
    parent = list(range(len(s)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(root(x), x) for x in range(len(s)) if root(x) != x]


def links(nodes: DataFrame, radius: int = 2, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """(u, v), u > v: edges between fingerprints that connect all those linked by at most radius bits."""
    n = nodes.count()
    some = nodes.where(F.abs(F.xxhash64("fp") % 1_000_003) < int(np.ceil(1_000_003 * min(1.0, sample / max(1, n)))))
    tree = Tree(some.select("fp").toArrow().column("fp").to_numpy().astype(np.int64).view(np.uint64), n, radius, leaf)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, rows in tree.route(fps):
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fps[rows].view(np.int64))], ["shard", "fp"])

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(pdf["fp"].to_numpy())
        e = _forest(fps.view(np.uint64), radius)
        return pd.DataFrame({"u": fps[[b for _, b in e]], "v": fps[[a for a, _ in e]]}, dtype="int64")

    return nodes.select("fp").mapInArrow(route, "shard long, fp long").groupBy("shard").applyInPandas(search, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges with the smallest node of its component, by large- and small-star steps. Each step's edges are a table that replaces the one before."""
    e = keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(redealt(F.col("u")).alias("k"), "m")
        large = both.join(low.hint("merge"), F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(redealt(F.col("u")).alias("k"), "m")
        small = large.join(low.hint("merge"), F.col("u") == F.col("k")).select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        new = keep(small.select("x.u", "x.v").where("u <> v").distinct())
        release(e)
        e = new
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == mark or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def cluster(documents: DataFrame, radius: int = 2, shingle: int = 3, **search) -> DataFrame:
    """(doc_id, t, fp, component_id) per document."""
    fps = cut(fingerprints(documents, shingle))
    nodes = keep(fps.groupBy("fp").agg(F.min("doc_id").alias("id")))
    roots = components(links(nodes, radius, **search))
    named = nodes.join(roots.hint("merge"), nodes["fp"] == roots["node"], "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("id").alias("component_id")).select(redealt(F.col("root")).alias("r"), "component_id")
    named = named.join(ids.hint("merge"), F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    return fps.join(named.hint("merge"), F.col("fp") == F.col("f")).select("doc_id", "t", "fp", "component_id")


def near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document."""
    return cluster(documents, **options).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _hashes(texts: DataFrame, shingle: int, similarity: float, low: bool) -> DataFrame:
    """(t, n, need, h) per text and distinct shingle with a low hash, or with another: h the shingle's hash, n how many the text has, and need how many
    of its low ones must be shared for the text to have a near copy. Where that is none the text has a row without h."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        of = xxhash.xxh64_intdigest
        for b in batches:
            for t, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw, starts, ends = _shingles(text.as_py(), shingle)
                h = np.unique(np.array([of(raw[x:y], 42) for x, y in zip(starts, ends, strict=True)], np.uint64))
                first = (h & np.uint64(255)) < LOW
                n, need = len(h), int(np.ceil(similarity * len(h) - 1e-6)) - int(np.count_nonzero(~first))
                h = h[first if low else ~first].view(np.int64)
                if low and n and need <= 0:  # none of its low ones need be shared, so it goes on whether or not any is
                    yield pa.RecordBatch.from_arrays([pa.array([t]), pa.array([n], pa.int32()), pa.array([need], pa.int32()), pa.array([None], pa.int64())], names)
                for at in range(0, len(h), 1 << 16):
                    part = h[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), t)), pa.array(np.full(len(part), n, np.int32)), pa.array(np.full(len(part), need, np.int32)), pa.array(part)], names)

    names = ["t", "n", "need", "h"]
    found = texts.mapInArrow(work, "t long, n int, need int, h long")
    return found.select("t", (F.col("n").cast("long") * (1 << 32) + F.col("need") + (1 << 31)).alias("k"), F.coalesce("h", F.expr(_MARK)).alias("h"))


#: The h of a row that stands for its text alone.
_MARK = "t ^ 6510615555426900570L"


def _shared(rows: DataFrame) -> DataFrame:
    """(t, k, x): the rows whose h stands in several texts, x being how many these are and h; and the rows of texts alone, x being null."""
    d = rows.withColumn("c", F.count("*").over(Window.partitionBy("h"))).where((F.col("c") > 1) | (F.col("h") == F.expr(_MARK)))
    return d.select("t", "k", F.when(F.col("h") != F.expr(_MARK), F.struct("c", "h")).alias("x"))


def _lists(documents: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(t, n, own, more), kept: of texts that may have near copies the number of shingles, those that other such texts have, too, by how many do, and how many of them are keys."""
    texts = keep(documents.select(F.xxhash64("text").alias("t"), F.col("text").cast("string").alias("text")).dropDuplicates(["t"]))
    rows = keep(_shared(_hashes(texts, shingle, similarity, True)))
    n, need = F.shiftright("k", 32).cast("int"), F.col("k").bitwiseAND(F.lit((1 << 32) - 1)) - (1 << 31)
    low = keep(rows.groupBy("t").agg(F.first("k").alias("k"), F.collect_list("x").alias("a")).where(F.size("a") >= need).select("t", n.alias("n"), "a"))
    release(rows)
    some = texts.join(low.select(F.col("t").alias("_t")).hint("merge"), F.col("t") == F.col("_t")).select("t", "text")
    high = keep(_shared(_hashes(some, shingle, similarity, False)).select("t", "x"))
    release(texts)
    more = high.groupBy(F.col("t").alias("_t")).agg(F.collect_list("x").alias("b")).hint("merge")
    lists = low.join(more, F.col("t") == F.col("_t"), "left").select("t", "n", F.sort_array(F.concat("a", F.coalesce("b", F.array().cast("array<struct<c:bigint,h:bigint>>")))).alias("own"))
    lists = lists.withColumn("own", F.col("own.h")).withColumn("more", F.size("own") - _least(F.col("n"), similarity) + 1)
    lists = keep(lists.where("more > 0"))
    release(low)
    release(high)
    return lists


def _least(n: Column, share: float) -> Column:
    """The least whole number that is not under share * n, rounding errors aside."""
    return F.ceil(n * share - 1e-6).cast("int")


def _verified(pairs: DataFrame, lists: DataFrame, similarity: float) -> DataFrame:
    """(u, v): the pairs whose sets of shingles reach the similarity; lists hold all shingles that two texts can have in common."""
    for end in ("u", "v"):
        pairs = pairs.join(lists.select(F.col("t").alias(f"t_{end}"), F.col("n").alias(f"n_{end}"), F.col("own").alias(f"o_{end}")).hint("merge"), F.col(end) == F.col(f"t_{end}"))
    common = F.size(F.array_intersect("o_u", "o_v"))
    return pairs.where(common >= similarity * (F.col("n_u") + F.col("n_v") - common) - 1e-6).select("u", "v")


def candidates(documents: DataFrame, shingle: int, radius: int = 2) -> DataFrame:
    """(u, v): pairs of texts, by their hashes, that connect all whose fingerprints are equal or linked by the tree: each with the first of its fingerprint, and the first ones of linked fingerprints."""
    fps = keep(fingerprints(documents, shingle).select("t", "fp").distinct())
    nodes = keep(fps.groupBy("fp").agg(F.min("t").alias("head")))
    pairs = links(nodes, radius)
    for end in ("u", "v"):
        pairs = pairs.join(nodes.select(F.col("fp").alias("_fp"), F.col("head").alias(f"h_{end}")).hint("merge"), F.col(end) == F.col("_fp")).drop("_fp")
    equal = fps.join(nodes.select(F.col("fp").alias("_fp"), "head").hint("merge"), F.col("fp") == F.col("_fp")).where("t <> head")
    found = keep(equal.select(F.col("t").alias("u"), F.col("head").alias("v")).union(pairs.select("h_u", "h_v")))
    release(fps)
    release(nodes)
    return found


def similar(documents: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, t, root) per document: root is equal for documents that links connect."""
    guesses = candidates(documents, shingle)
    lists = _lists(documents, shingle, similarity)
    near = keep(_verified(guesses, lists, similarity))
    release(guesses)

    def with_roots(edges: DataFrame) -> DataFrame:
        return keep(lists.join(components(edges).hint("merge"), F.col("t") == F.col("node"), "left").select("t", "n", "own", "more", F.coalesce("root", "t").alias("root")))

    def keys(rows: DataFrame, *columns: str) -> DataFrame:
        """The prefix of each list by key h; left is how many of the text's shingles come from there on."""
        d = rows.select("t", "n", *columns, F.size("own").alias("_m"), F.posexplode(F.slice("own", F.lit(1), F.col("more"))).alias("j", "h"))
        return d.select("h", "t", "n", *columns, (F.col("_m") - F.col("j")).alias("left"))

    def can(a: str, b: str) -> Column:
        return F.least(f"{a}left", f"{b}left") >= _least(F.col(f"{a}n") + F.col(f"{b}n"), similarity / (1 + similarity))

    def both(a: str, b: str) -> list[Column]:
        return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]

    own_share = (F.col("n") - F.col("m")) / F.col("n")
    tied = with_roots(near)
    drawn = [F.min(F.struct(o.alias("o"), F.xxhash64("t").alias("x"), "t", "n", "left", "root")).alias(f"r{i}") for i, o in enumerate((own_share, F.lit(0.0)))]
    drawn = keys(tied.withColumn("m", F.size("own")), "m", "root").groupBy("h").agg(F.min("root").alias("a"), F.max("root").alias("b"), *drawn).where("a <> b")
    drawn = drawn.select(redealt(F.col("h")).alias("q"), F.explode(F.array_distinct(F.array(*(F.struct(*(F.col(f"r{i}")[x].alias(f"r_{x}") for x in ("t", "n", "left", "root"))) for i in (0, 1))))).alias("r")).select("q", "r.*")
    pairs = keys(tied, "root").join(drawn.hint("merge"), F.col("h") == F.col("q")).where((F.col("root") != F.col("r_root")) & can("", "r_")).select(*both("t", "r_t")).distinct()
    first = keep(near.union(_verified(pairs, lists, similarity)))
    release(tied)
    release(near)

    rooted = with_roots(first)
    per = keys(rooted, "root").groupBy("h", "root").agg(F.count("*").alias("c"))
    per = per.groupBy("h").agg(F.count("*").alias("roots"), F.max(F.struct("c", "root")).alias("most")).where("roots > 1")
    per = per.select(redealt(F.col("h")).alias("q"), F.col("most.root").alias("most"))
    mixed = keep(keys(rooted, "root").join(per.hint("merge"), F.col("h") == F.col("q")).drop("q"))
    few = mixed.where("root <> most").select(*(F.col(x).alias(f"f_{x}") for x in ("h", "t", "n", "left", "root")))
    once = (F.col("root") == F.col("most")) | (F.col("t") < F.col("f_t"))
    pairs = few.join(mixed.hint("merge"), (F.col("h") == F.col("f_h")) & (F.col("root") != F.col("f_root")) & once & can("", "f_")).select(*both("t", "f_t")).distinct()
    second = _verified(pairs, lists, similarity)

    ids = documents.select("doc_id", F.xxhash64("text").alias("t"), (F.btrim(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(SPACES)) == "").alias("blank"))
    blank = ids.where("blank").select("t").distinct()
    blank = blank.crossJoin(blank.agg(F.min("t").alias("head"))).select(F.col("t").alias("u"), F.col("head").alias("v"))
    roots = components(first.union(second).union(blank))
    for used in (lists, first, rooted, mixed):
        release(used)
    return ids.join(roots.hint("merge"), F.col("t") == F.col("node"), "left").select("doc_id", "t", F.coalesce("root", "t").alias("root"))


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """One document of each group of similar ones, all columns: the one with the smallest doc_id (of repeated rows, one)."""
    c = keep(similar(documents, **options))
    by = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "t")
    best = keep(c.groupBy(F.col("root").alias("c")).agg(F.min(by).alias("best"), F.count("*").alias("n")).where("n > 1").select("c", "best"))
    rest = c.join(best.hint("merge"), F.col("root") == F.col("c")).where(by != F.col("best")).select(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).distinct()
    boxed = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("_k"), F.xxhash64("text").alias("_x"))
    kept = boxed.join(rest.hint("merge"), F.col("_k").eqNullSafe(F.col("_id")) & (F.col("_x") == F.col("_t")), "left_anti")
    repeated = c.groupBy("doc_id", "t").count().where("count > 1").join(best, F.col("best").eqNullSafe(by), "left_semi")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["_k", "_x"])
    return kept.select("row.*")


def brute(texts: dict[int, str | None], radius: int = 2) -> dict[int, tuple[str, int]]:
    """doc_id: (fingerprint, component_id), by comparing all pairs and hashing each shingle from its words."""
    import xxhash

    out: dict[int, int] = {}
    for k, t in texts.items():
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        out[k] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    own = {k: k for k in out}
    changed = True
    while changed:
        changed = False
        for a in out:
            for b in out:
                if own[b] < own[a] and (out[a] ^ out[b]).bit_count() <= radius:
                    own[a], changed = own[b], True
    return {k: (f"{out[k]:016x}", own[k]) for k in out}
