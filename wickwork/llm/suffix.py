"""Suffix-array dedup of passages, by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if a string of ``length`` bytes that covers it also starts earlier, in a smaller doc_id or before in the
same document. Strings (windows) that repeat are found in shards of text small enough for one task:

1. Each window is dealt by its minimizer: the k-gram in it with the smallest hash (leftmost on ties). Equal windows
   have equal minimizers. Consecutive windows with one minimizer are a segment of a document.
2. Minimizers that occur once are dropped, with all their windows: none of those can repeat. Segments that are equal
   in bytes are interned: the first occurrence stands for all in what follows.
3. A shard holds all interned segments of its minimizers. Their texts are sorted by their first ``length`` bytes, which
   gives the transform. Intervals of suffixes are then extended backwards, breadth first, so that common prefixes are
   found by increasing value (Beller, Gog, Ohlebusch, Schnattinger, "Computing the longest common prefix array based on
   the Burrows-Wheeler transform"); the search ends at ``length``. Entries not reached by then join suffixes that agree
   in that many bytes: each maximal run of them is a class of equal windows, and all but its earliest one go.
4. Later occurrences of an interned segment lose what it covers, too; per document the spans are merged.

A minimizer with more than ``HOT`` distinct segments (a passage in a large part of the corpus, with other words around it each time) is not one shard's business.
The windows of its segments are interned one by one, by a 128-bit hash: the earliest of equal ones stands for all, the others go by a join that can be split.
Distinct windows of one length are classes of their own, so nothing of them is left for a search. So no shard has more than some ``PER_SHARD`` segments and
those of one minimizer, ``HOT`` at most, and no shard grows with the corpus.

Texts are compared as UTF-8 bytes. A null or empty text has no bytes. Of rows that repeat a doc_id, the order among
them is that of the input's partitions and rows; null ids come last. Texts are kept compressed in the shared folder while this
runs, dealt by row, so that they cross the network once. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.llm.common import cut, keep, partitions, release

LENGTH, GRAM, HOT, PER_SHARD, PIECE = 100, 32, 5_000, 2_000, 1 << 19
_RNG = np.random.default_rng(20_240_229)
_TABLE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RNG.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64((1 << 24) - 1)


def gram_hashes(buf: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k bytes (k a power of two)."""
    h, n = _TABLE[buf], 1
    while n < k:
        h = h[:-n] * _FACTORS[n.bit_length()] + h[n:]
        n *= 2
    h = (h ^ (h >> np.uint64(32))) * _FACTORS[0]
    return h ^ (h >> np.uint64(29))


def segments(buf: np.ndarray, bounds: list[tuple[int, int]], length: int = LENGTH, gram: int = GRAM):
    """(start, windows, minimizer hash) arrays over the documents at bounds in buf (under 2**24 bytes)."""
    w = length - gram + 1
    h = gram_hashes(buf, gram)
    m = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    n = 1
    while 2 * n <= w:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    if n < w:
        m = np.minimum(m[: len(m) - (w - n)], m[w - n :])
    at = (m & _LOW).astype(np.int64)
    valid = np.zeros(len(at) + 1, bool)
    for a, b in bounds:
        valid[a : max(a, b - length + 1)] = True
    valid[-1] = False
    new = np.empty(len(at), bool)
    new[:1] = True
    new[1:] = (at[1:] != at[:-1]) | (valid[1:-1] != valid[:-2])
    for a, _ in bounds:
        if a < len(new):
            new[a] = True
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(at)))
    keep = valid[starts]
    starts, count = starts[keep], count[keep]
    return starts, count, h[at[starts]]


def occurrences(base: DataFrame, length: int = LENGTH, gram: int = GRAM, whole: bool = True) -> DataFrame:
    """(anchor, seg, rid, at) of every segment of base (rid, z), or its anchor alone; at is start << 8 | windows."""
    names = ["anchor", "seg", "rid", "at"] if whole else ["anchor"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        for b in batches:
            unpack = zstandard.ZstdDecompressor().decompress
            parts: list[bytes] = []
            owners: list[tuple[int, int, int, int]] = []  # row, start in the text, from and to in the buffer
            size = 0

            def flush():
                nonlocal size
                raw = b"".join(parts)
                starts, count, anchor = segments(np.frombuffer(raw, np.uint8), [(x, y) for _, _, x, y in owners], length, gram)
                columns = [pa.array(anchor.view(np.int64))]
                if whole:
                    seg = np.array([xxhash.xxh64_intdigest(raw[s:e]) for s, e in zip(starts.tolist(), (starts + count + length - 1).tolist(), strict=True)], np.uint64)
                    o = np.array(owners, np.int64).reshape(-1, 4)
                    k = np.searchsorted(o[:, 2], starts, "right") - 1
                    columns += [pa.array(seg.view(np.int64)), b.column(0).take(pa.array(o[k, 0])), pa.array((starts - o[k, 2] + o[k, 1]) << 8 | count)]
                parts.clear()
                owners.clear()
                size = 0
                return pa.RecordBatch.from_arrays(columns, names)

            for i, z in enumerate(b.column(1)):
                raw = unpack(z.as_py())
                for at in range(0, len(raw) - length + 1, PIECE):
                    part = raw[at : at + PIECE + length - 1]
                    parts.append(part)
                    owners.append((i, at, size, size + len(part)))
                    size += len(part)
                    if size >= PIECE:
                        yield flush()
            if owners:
                yield flush()

    return base.select("rid", "z").mapInArrow(run, ", ".join(f"{n} long" for n in names))


SEED = 8  # symbols that fit in one sort key


def suffix_order(s: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array by the first depth symbols (ties in any order), and for the first min(depth, SEED) symbols
    alone, packed: the sorted keys and where in the array they change.

    Prefix doubling; only suffixes that are not alone with their prefix are sorted again.
    """
    n, known = len(s), min(depth, SEED)
    padded = np.concatenate([s, np.zeros(known, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(known):
        key = key << np.uint64(8) | padded[i : n + i].astype(np.uint64)
    order = np.argsort(key)
    keys = key[order]
    new = np.ones(n, bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    places = np.flatnonzero(~(new & np.append(new[1:], True)))
    while known < depth and len(places):
        step = min(known, depth - known)
        sub = order[places]
        after = sub + step
        key = rank[sub] << np.int64(32) | np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        o = np.argsort(key)
        key, sub = key[o], sub[o]
        order[places] = sub
        fresh = np.ones(len(sub), bool)
        fresh[1:] = key[1:] != key[:-1]
        begin = np.flatnonzero(fresh)
        rank[sub] = np.repeat(places[begin], np.diff(np.append(begin, len(sub))))
        places = places[~(fresh & np.append(fresh[1:], True))]
        known += step
    return order, keys, starts


def prefix_classes(s: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, bounds): bounds[i] is False where suffixes i - 1 and i of the array share depth symbols at least.

    The search begins with the intervals of all strings of SEED symbols, which come with the sort. s holds symbols
    under 256; 0 separates texts and stands at the end. Intervals of strings with a 0 are not extended, so a
    suffix with a 0 in its first depth symbols may seem to agree with the next one; callers skip those.
    """
    n = len(s)
    order, keys, starts = suffix_order(s, depth)
    bwt = s[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    step = np.empty(n, np.int64)  # from a suffix to the one that starts a symbol before
    step[by_symbol] = np.arange(n)
    first = bwt[by_symbol]
    bounds = np.zeros(n + 1, bool)
    bounds[starts] = bounds[n] = True
    los, his = starts, np.append(starts[1:], n) - 1
    whole = np.ones(len(starts), bool)
    for i in range(min(depth, SEED)):
        whole &= (keys[starts] >> np.uint64(8 * i) & np.uint64(255)) > 0
    los, his = los[whole], his[whole]
    for _ in range(min(depth, SEED), depth):
        if not len(los):
            break
        one = los == his
        single = step[los[one]]
        single = single[(first[single] > 0) & ~bounds[single + 1]]
        lo, hi = los[~one], his[~one]
        if len(lo):
            size = hi - lo + 1
            owner = np.repeat(np.arange(len(lo)), size)
            member = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size - lo, size)
            key = np.sort(owner * np.int64(n) + step[member])
            owner, at = np.divmod(key, np.int64(n))
            symbol = first[at]
            cutoff = np.flatnonzero((owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1]))
            lo, hi = at[np.concatenate([[0], cutoff + 1])], at[np.append(cutoff, len(at) - 1)]
            keep = (first[lo] > 0) & ~bounds[hi + 1]
            lo, hi = lo[keep], hi[keep]
        los, his = np.concatenate([single, lo]), np.concatenate([single, hi])
        bounds[his + 1] = True
    return order, bounds[:n]


def repeated_windows(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For texts in order of their rank: the offsets in each of the windows that occur at a smaller (text, offset)."""
    sizes = np.array([len(t) + 1 for t in texts])
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    ends = np.cumsum(sizes)
    used = np.bincount(raw, minlength=256) > 0
    s = np.cumsum(used).astype(np.uint8)[raw] if not used.all() else raw.copy()
    s[ends - 1] = 0
    order, bounds = prefix_classes(s, length)
    starts = np.flatnonzero(bounds)
    count = np.diff(np.append(starts, len(s)))
    starts, count = starts[count > 1], count[count > 1]
    at = np.concatenate([[0], np.cumsum(count)])
    place = order[np.arange(at[-1]) + np.repeat(starts - at[:-1], count)]
    place = np.where(ends[np.searchsorted(ends, place, "right")] - 1 - place >= length, place, len(s))
    least = np.repeat(np.minimum.reduceat(place, at[:-1]), count) if len(starts) else place
    gone = np.sort(place[(place < len(s)) & (place > least)])
    cuts = np.searchsorted(gone, ends[:-1])
    return [g - b for g, b in zip(np.split(gone, cuts), ends - sizes, strict=True)]


def _spans(offsets: np.ndarray, length: int) -> list[int]:
    """Windows at sorted offsets as merged byte spans, from and to by turns."""
    if not len(offsets):
        return []
    breaks = np.flatnonzero(np.diff(offsets) > length)
    a, b = offsets[np.append(0, breaks + 1)], offsets[np.append(breaks, len(offsets) - 1)] + length
    return np.column_stack([a, b]).ravel().tolist()


def _wanted(base: DataFrame, segs: DataFrame) -> DataFrame:
    """(rid, z, segs): rows of base with those of the segments that lie in them."""
    lists = segs.groupBy(F.col("rid").alias("r")).agg(F.collect_list(F.struct("anchor", "seg", "at")).alias("segs"))
    return base.select("rid", "z").join(lists.hint("merge"), F.col("rid") == F.col("r")).select("rid", "z", "segs")


def shard_texts(base: DataFrame, segs: DataFrame, shards: int, length: int) -> DataFrame:
    """(shard, anchor, seg, rid, start, text) of segments: what the shards search."""
    kinds = {"shard": pa.int64(), "anchor": pa.int64(), "seg": pa.int64(), "rid": pa.int64(), "start": pa.int64(), "text": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, list(kinds))

        for b in batches:
            unpack = zstandard.ZstdDecompressor().decompress
            for rid, z, wanted in zip(*b.columns, strict=True):
                rid, raw = rid.as_py(), unpack(z.as_py())
                for x in wanted.as_py():
                    start, n, anchor = x["at"] >> 8, x["at"] & 255, x["anchor"]
                    rows.append(((anchor ^ anchor >> 32) % shards, anchor, x["seg"], rid, start, raw[start : start + n + length - 1]))
                    if len(rows) >= 20_000:
                        yield out()
        if rows:
            yield out()

    return _wanted(base, segs).mapInArrow(run, "shard long, anchor long, seg long, rid long, start long, text binary")


def _one_by_one(base: DataFrame, segs: DataFrame, length: int) -> DataFrame:
    """(anchor, seg, spans): what the windows of these segments lose to equal windows before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        for b in batches:
            unpack = zstandard.ZstdDecompressor().decompress
            for rid, z, wanted in zip(*b.columns, strict=True):
                rid, raw = rid.as_py(), unpack(z.as_py())
                for x in wanted.as_py():
                    start, n = x["at"] >> 8, x["at"] & 255
                    h = [xxhash.xxh3_128_digest(raw[o : o + length]) for o in range(start, start + n)]
                    same = lambda v, t=pa.int64(), n=n: pa.array(np.full(n, v), t)
                    yield pa.RecordBatch.from_arrays([pa.array(h, pa.binary()), same(rid), pa.array(np.arange(start, start + n)), same(x["anchor"]), same(x["seg"]), pa.array(np.arange(n), pa.int32())], names)

    names = ["w", "rid", "place", "anchor", "seg", "off"]
    windows = keep(_wanted(base, segs).mapInArrow(run, "w binary, rid long, place long, anchor long, seg long, off int"))
    first = keep(windows.groupBy("w").agg(F.min(F.struct("rid", "place")).alias("f"), F.count("*").alias("c")).where("c > 1").select(F.col("w").alias("_w"), F.col("f.rid").alias("r"), F.col("f.place").alias("q")))
    gone = windows.join(first.hint("merge"), F.col("w") == F.col("_w")).where("rid <> r or place <> q")

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"anchor": pdf["anchor"].iloc[:1], "seg": pdf["seg"].iloc[:1], "spans": [_spans(np.sort(pdf["off"].to_numpy()).astype(np.int64), length)]})

    return gone.select("anchor", "seg", "off").groupBy("anchor", "seg").applyInPandas(merged, "anchor long, seg long, spans array<int>")


def spans_by_row(base: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, per_shard: int = PER_SHARD) -> DataFrame:
    """(rid, spans): the byte spans (from and to by turns, not merged) that go, of rows that lose any."""
    if length - gram + 1 > 255:
        raise ValueError("at most 255 windows share a minimizer")
    twice = keep(occurrences(base, length, gram, whole=False).groupBy(F.col("anchor").alias("a")).agg(F.count("*").alias("c")).where("c > 1").select("a"))
    occ = occurrences(base, length, gram)
    occ = keep(occ.join(twice, F.col("anchor") == F.col("a")).drop("a"))
    segs = keep(occ.groupBy("anchor", "seg").agg(F.min(F.struct("rid", "at")).alias("f")).select("anchor", "seg", "f.rid", "f.at"))
    release(twice)
    many = keep(segs.groupBy(F.col("anchor").alias("a")).agg(F.count("*").alias("c")).where(F.col("c") > hot).select("a"))
    shards = max(1, -(-segs.count() // per_shard))
    hottest = not many.isEmpty()
    cold = segs.join(many.hint("merge"), F.col("anchor") == F.col("a"), "left_anti") if hottest else segs

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rid", "start"])
        found = repeated_windows(pdf["text"].tolist(), length)
        spans = [_spans(g, length) for g in found]
        return pd.DataFrame({"anchor": pdf["anchor"], "seg": pdf["seg"], "spans": spans})[[bool(x) for x in spans]]

    own = shard_texts(base, cold, shards, length).groupBy("shard").applyInPandas(search, "anchor long, seg long, spans array<int>")
    if hottest:
        own = own.union(_one_by_one(base, segs.join(many.hint("merge"), F.col("anchor") == F.col("a")).drop("a"), length))
    own = keep(own)
    first = segs.select(F.col("anchor").alias("a"), F.col("seg").alias("s"), F.col("rid").alias("r"), F.col("at").alias("b"))
    mine = segs.join(own, ["anchor", "seg"]).select("rid", F.expr("transform(spans, x -> shiftright(at, 8) + x)").alias("spans"))
    later = occ.join(first, (F.col("anchor") == F.col("a")) & (F.col("seg") == F.col("s"))).where("rid <> r or at <> b")
    later = later.select("rid", F.expr(f"array(shiftright(at, 8), shiftright(at, 8) + (at & 255) + {length - 1})").alias("spans"))
    out = keep(mine.union(later).groupBy("rid").agg(F.flatten(F.collect_list("spans")).alias("spans")))
    for used in (occ, segs, many, own):
        release(used)
    return out


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, where texts are held unpacked."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def packed(documents: DataFrame) -> DataFrame:
    """documents as (rid, doc_id, z, n_bytes, row): z the compressed text, row the other columns; kept in the shared folder, dealt by rid.

    rid numbers the rows in the order of doc_id (nulls last, repeats as they come): it is doc_id itself where that is a unique integer."""
    others = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for b in _slices(batches):
            raw = [(x.as_py() or "").encode("utf-8", "surrogatepass") for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([pack(x) for x in raw], pa.binary()), pa.array([len(x) for x in raw], pa.int64()), b.column(3)], ["rid", "doc_id", "z", "n_bytes", "row"])

    twice = documents.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    plain = kind in ("bigint", "int", "smallint", "tinyint") and twice.isEmpty()
    d = documents.select((F.col("doc_id").cast("long") if plain else F.monotonically_increasing_id()).alias("rid"), "doc_id", F.col("text").cast("string"), F.struct(*others).alias("row"))
    schema = f"rid long, doc_id {kind}, z binary, n_bytes long, row {d.schema['row'].dataType.simpleString()}"
    n = partitions(documents.sparkSession)
    if plain:
        return cut(d.mapInArrow(run, schema).repartition(n, "rid"))
    d = keep(d.mapInArrow(run, schema))
    ranks = d.select(F.col("rid").alias("old"), "doc_id").orderBy(F.col("doc_id").asc_nulls_last(), "old").select("old", F.monotonically_increasing_id().alias("new"))
    d = d.join(ranks, F.col("rid") == F.col("old")).select(F.col("new").alias("rid"), "doc_id", "z", "n_bytes", "row")
    return cut(d.repartition(n, "rid"))


def merge(spans: list[int] | None) -> list[tuple[int, int]]:
    """Spans that are maximal and apart."""
    out: list[list[int]] = []
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)) if spans else []:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remaining(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    return b"".join(raw[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(raw)], strict=True))


def _applied(documents: DataFrame, **options) -> DataFrame:
    base = packed(documents)
    spans = spans_by_row(base, **options)
    return base.join(spans.select(F.col("rid").alias("r"), "spans"), F.col("rid") == F.col("r"), "left")


def dedup(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            removed, count, sha = [], [], []
            for z, s in zip(b.column(2), b.column(3), strict=True):
                spans = merge(s.as_py())
                removed.append(sum(y - x for x, y in spans))
                count.append(len(spans))
                sha.append(hashlib.sha256(remaining(unpack(z.as_py()), spans)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return _applied(documents, **options).select("doc_id", "n_bytes", "z", "spans").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(documents: DataFrame, **options) -> DataFrame:
    """documents, all columns, whose texts lost their repeated bytes (and bytes of characters that a span cuts through); n_chars, where there is one, follows. A null text comes out empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for b in _slices(batches):
            text = [remaining(unpack(z.as_py()), merge(s.as_py())).decode("utf-8", "ignore") if s.is_valid else None for z, s in zip(b.column(1), b.column(2), strict=True)]
            whole = [unpack(z.as_py()).decode("utf-8", "surrogatepass") if t is None else t for z, t in zip(b.column(1), text, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(whole, pa.string()), pa.array([t is not None for t in text])], ["row", "text", "new"])

    names = documents.columns
    d = _applied(documents, **options)
    kind = d.schema["row"].dataType.simpleString()
    d = d.select("row", "z", "spans").mapInArrow(run, f"row {kind}, text string, new boolean")
    new = {"text": F.col("text")}
    if "n_chars" in names:
        new["n_chars"] = F.when(F.col("new"), F.length("text").cast(documents.schema["n_chars"].dataType)).otherwise(F.col("row")["n_chars"])
    return d.select(*((new[c] if c in new else F.col("row").getField(c)).alias(c) for c in names))


def brute(texts: dict[int, str | None], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """doc_id: (n_bytes, n_removed, n_spans, kept_sha256), from a set of all strings seen so far."""
    seen: set[bytes] = set()
    out = {}
    for k in sorted(texts):
        raw = (texts[k] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            else:
                seen.add(raw[i : i + length])
        left = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        out[k] = (len(raw), sum(gone), len(bytes(gone).split(b"\0")) - bytes(gone).split(b"\0").count(b""), hashlib.sha256(left).hexdigest())
    return out
