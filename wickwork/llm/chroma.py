"""Chroma audio fingerprints over a media column, and a search that aligns recordings.

A recording (WAV, 16-bit PCM, channels averaged) becomes frames of twelve pitch-class energies. Sixteen filters compare
sums of rectangles of that image, taken from its integral image, within sixteen frames; each comparison is quantised to two
bits (Gray code), which gives one packed 32-bit integer per frame.

Search: recordings with equal fingerprints are one class, so copies cost no pairs. Classes that share an integer with a query's
class are candidates; the histogram of offsets between equal integers gives the alignment, and the share of differing
bits over the aligned frames decides. All rows are indexed; no list is cut short. Windows of silence say nothing about a
recording and are not looked up (they count in the share of bits); so silence, which all recordings share, joins nothing.
An integer that more than ``COMMON`` classes hold (a tone that is held on) would join each with each, position by position. Classes that have one in common with a query's class
are not joined but compared, block by block: runs of equal integers against such runs, all their integers, so that the histogram and its best offset are the same as by the join. That takes
time by the number of such pairs of recordings, and no rows of votes.

A recording that is null, unreadable or shorter than one filter window has an empty fingerprint, which matches nothing. Rows that repeat an id count as
copies. A null id is indexed and never a query. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.llm.common import cut, keep

WIDTH, CLASSES, LOWEST, HIGHEST = 16, 12, 100.0, 1900.0
MAX_BIT_ERROR, MIN_HITS, MIN_OVERLAP, QUERY_EVERY, COMMON = 0.2, 2, 32, 100, 1000
#: Frames of queries, and of classes, that a task compares; cells of histograms that it holds at once.
TASK_FRAMES, CELLS = 1 << 18, 1 << 20


#: The integer of a window without sound: each comparison comes out even.
SILENT = int("01" * 16, 2)


def filters() -> list[tuple[int, int, int, int]]:
    """(kind, first class, classes, frames) of the sixteen filters: each kind of split over bands that move through the octave."""
    return [(k % 4, (5 * k) % CLASSES % 7, 4 + k % 3 * 2 if k % 4 in (0, 2) else 6, (4, 8, 12, 16)[k // 4]) for k in range(16)]


def read_wav(raw: bytes | None) -> tuple[np.ndarray, int]:
    try:
        with wave.open(io.BytesIO(raw or b"")) as w:
            if w.getsampwidth() != 2:
                return np.zeros(0), 1
            x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels())
            return x.mean(axis=1) / 32768, w.getframerate()
    except (wave.Error, EOFError):
        return np.zeros(0), 1


def write_wav(samples: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def chroma(samples: np.ndarray, rate: int) -> np.ndarray:
    """(frames, 12) pitch-class energies, each frame of unit length."""
    frame = 1 << max(4, round(np.log2(rate / 8)))
    hop = frame // 4
    if len(samples) < frame:
        return np.zeros((0, CLASSES))
    views = np.lib.stride_tricks.sliding_window_view(samples, frame)[::hop]
    freq = np.fft.rfftfreq(frame, 1 / rate)
    use = (freq >= LOWEST) & (freq <= HIGHEST)
    pitch = np.zeros((int(use.sum()), CLASSES))
    pitch[np.arange(len(pitch)), np.round(12 * np.log2(freq[use] / 440)).astype(int) % 12] = 1
    out = []
    for at in range(0, len(views), 4096):
        energy = np.abs(np.fft.rfft(views[at : at + 4096] * np.hanning(frame), axis=1)[:, use]) ** 2 @ pitch
        norm = np.linalg.norm(energy, axis=1, keepdims=True)
        out.append(np.where(norm > 1e-6, energy / np.maximum(norm, 1e-6), 0))
    return np.concatenate(out)


def fingerprint(raw: bytes | None) -> np.ndarray:
    """The packed integers of a recording."""
    image = chroma(*read_wav(raw))
    n = len(image) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    total = np.zeros((len(image) + 1, CLASSES + 1))
    total[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)
    at = np.arange(n)

    def area(t: int, w: int, c: int, h: int) -> np.ndarray:
        return total[at + t + w, c + h] - total[at + t, c + h] - total[at + t + w, c] + total[at + t, c]

    out = np.zeros(n, np.uint32)
    for kind, c, h, w in filters():
        h = min(h, CLASSES - c)
        whole = area(0, w, c, h)
        if kind == 0:
            part = area(0, w, c, h // 2)
        elif kind == 1:
            part = area(0, w // 2, c, h)
        elif kind == 2:
            part = area(0, w // 2, c, h // 2) + area(w // 2, w - w // 2, c + h // 2, h - h // 2)
        else:
            part = area(w // 4, w // 2, c, h)
        ratio = np.log((1 + part) / (1 + whole - part))
        level = (ratio > -0.3).astype(np.uint32) + (ratio > 0) + (ratio > 0.3)
        out = out << np.uint32(2) | np.array([0, 1, 3, 2], np.uint32)[level]
    return out


def fingerprints(media: DataFrame, key: str, column: str) -> DataFrame:
    """(key, fp) of every row: fp an array of int."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint(x.as_py()).view(np.int32) for x in b.column(1)]
            values = np.concatenate([*found, np.zeros(0, np.int32)])
            ends = np.cumsum([0, *(len(x) for x in found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], [key, "fp"])

    d = media.select(key, column)
    return d.mapInArrow(run, f"{key} {d.schema[key].dataType.simpleString()}, fp array<int>")


def lookups(prints: DataFrame, key: str, common: DataFrame | None) -> DataFrame:
    """(key, pos, value) of every frame of fp that is neither silent nor a common integer."""
    d = prints.select(key, F.posexplode("fp").alias("pos", "v")).where(F.col("v") != SILENT)
    if common is not None:
        d = d.join(common.hint("merge"), F.col("v") == F.col("_v"), "left_anti")
    return d.select(key, "pos", F.col("v").cast("long").alias("value"))


def often(classes: DataFrame, common: DataFrame) -> DataFrame:
    """classes with a column often: the common integers that a class holds, an empty array if it has none."""
    held = classes.select(F.col("match_id").alias("_m"), F.explode(F.array_distinct("fp")).alias("v")).join(common.hint("merge"), F.col("v") == F.col("_v"))
    held = held.groupBy("_m").agg(F.collect_list("v").alias("o"))
    d = classes.join(held.hint("merge"), F.col("match_id") == F.col("_m"), "left")
    return keep(d.select(*classes.columns, F.coalesce("o", F.array().cast("array<int>")).alias("often")))


class _Lists:
    """Arrays of one column end to end, with their places."""

    def __init__(self, column: pa.ChunkedArray):
        c = column.combine_chunks()
        self.size = np.asarray(c.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        self.flat = c.flatten().to_numpy(zero_copy_only=False)
        self.start = np.cumsum(self.size) - self.size


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of these sizes end to end, which list each element is in and its place there."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _runs(fp: _Lists) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(list, place, length, integer) of each run of equal integers that isn't silent."""
    of, place = _spread(fp.size)
    first = np.flatnonzero((place == 0) | np.append(True, fp.flat[1:] != fp.flat[:-1])[: len(of)])
    length = np.diff(np.append(first, len(of)))
    loud = fp.flat[first] != SILENT
    return of[first][loud], place[first][loud], length[loud], fp.flat[first][loud]


def compare(heads: pa.Table, classes: pa.Table, min_hits: int, min_overlap: int, max_bit_error: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(row of heads, row of classes, offset, hits, overlap, differing bits) of each pair that has an integer of both its often in common and aligns.

    A run of l equal integers against one of k adds a trapezoid to the histogram of offsets, which is four steps in its second difference; so a tone costs four numbers however long it's held."""
    a, b = _Lists(heads["fp"]), _Lists(classes["fp"])
    often_a, often_b = _Lists(heads["often"]), _Lists(classes["often"])
    by = np.argsort(often_a.flat, kind="stable")
    common, holder = often_a.flat[by], np.repeat(np.arange(len(a.size)), often_a.size)[by]
    of, place, length, value = _runs(a)
    order = np.argsort(value, kind="stable")
    of, place, length, value = of[order], place[order], length[order], value[order]
    b_of, b_place, b_length, b_value = _runs(b)
    bounds = np.searchsorted(b_of, np.arange(len(b.size) + 1))

    for row, n in enumerate(b.size.tolist()):
        mine = often_b.flat[often_b.start[row] : often_b.start[row] + often_b.size[row]]
        lo, hi = np.searchsorted(common, mine), np.searchsorted(common, mine, "right")
        which, k = _spread(hi - lo)
        met = np.unique(holder[lo[which] + k])
        width = a.size[met] + n + 1
        chunk = (np.cumsum(width) - width) // CELLS
        x = slice(bounds[row], bounds[row + 1])
        p, m, v = b_place[x], b_length[x], b_value[x]
        lo, hi = np.searchsorted(value, v), np.searchsorted(value, v, "right")
        for c in np.unique(chunk):
            some, w = met[chunk == c], width[chunk == c]
            base = np.full(len(a.size), -1, np.int64)
            base[some] = np.cumsum(w) - w
            cells = int(w.sum())
            votes = np.zeros(cells, np.int64)
            part = np.cumsum(hi - lo) // CELLS
            for at in np.unique(part):
                here = np.flatnonzero(part == at)
                which, k = _spread((hi - lo)[here])
                i, j = lo[here][which] + k, here[which]
                use = base[of[i]] >= 0
                i, j = i[use], j[use]
                start = base[of[i]] + a.size[of[i]] + p[j] - place[i] - length[i]
                votes += np.bincount(np.concatenate([start, start + m[j] + length[i]]), minlength=cells)
                votes -= np.bincount(np.concatenate([start + m[j], start + length[i]]), minlength=cells)
            votes = votes.cumsum().cumsum()
            best = np.maximum.reduceat(votes * cells - np.arange(cells), base[some])
            hits = -(-best // cells)
            offset = hits * cells - best - base[some] - a.size[some] + 1
            begin, to = np.maximum(0, -offset), np.maximum(0, offset)
            overlap = np.minimum(a.size[some] - begin, n - to)
            good = (hits >= min_hits) & (overlap >= min_overlap)
            if not good.any():
                continue
            some, offset, hits, begin, to, overlap = (y[good] for y in (some, offset, hits, begin, to, overlap))
            which, k = _spread(overlap)
            differ = np.bitwise_count((a.flat[(a.start[some] + begin)[which] + k] ^ b.flat[b.start[row] + to[which] + k]).view(np.uint32))
            wrong = np.add.reduceat(differ, np.cumsum(overlap) - overlap, dtype=np.int64)
            good = wrong <= (max_bit_error + 1e-6) * 32 * overlap
            yield tuple(y[good].astype(np.int32) for y in (some, np.full(len(some), row), offset, hits, overlap, wrong))


def compared(heads: DataFrame, classes: DataFrame, min_hits: int, min_overlap: int, max_bit_error: float) -> DataFrame:
    """(class, match_id, copies, offset, hits, overlap, wrong) of the pairs of a query's class and another that have a common integer in common and align, by comparing blocks of both."""
    heads, classes = heads.where(F.size("often") > 0), classes.where(F.size("often") > 0)
    blocks, slices = (1 + (d.agg(F.sum(F.size("fp"))).first()[0] or 0) // TASK_FRAMES for d in (heads, classes))
    kind = classes.schema["match_id"].dataType.simpleString()
    names = ["class", "match_id", "copies", "offset", "hits", "overlap", "wrong"]

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [*compare(left, right, min_hits, min_overlap, max_bit_error)] if left.num_rows and right.num_rows else []
        i, j, *rest = (np.concatenate([np.zeros(0, np.int32), *x]) for x in (zip(*found, strict=True) if found else [()] * 6))
        return pa.table([left["class"].take(pa.array(i)), right["match_id"].take(pa.array(j)), right["copies"].take(pa.array(j)), *(pa.array(x, pa.int32()) for x in rest)], names)

    def dealt(d: DataFrame, key: str, own: str, n: int, other: str, m: int) -> DataFrame:
        d = d.select(*(F.col(x).alias(x) for x in d.columns), F.pmod(F.xxhash64(key), F.lit(n)).alias(own))  # aliases: both sides come from classes
        return d.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))).groupBy("block", "slice")

    left = dealt(heads, "class", "block", blocks, "slice", slices)
    right = dealt(classes, "match_id", "slice", slices, "block", blocks)
    found = left.cogroup(right).applyInArrow(work, f"class {kind}, match_id {kind}, copies long, offset int, hits int, overlap int, wrong int")
    return found.where(F.col("class") != F.col("match_id"))


def search(prints: DataFrame, key: str, every: int = QUERY_EVERY, max_bit_error: float = MAX_BIT_ERROR, min_hits: int = MIN_HITS, min_overlap: int = MIN_OVERLAP, common: int = COMMON) -> DataFrame:
    """(query_id, match_id, copies, offset, hits, bit_error): for each row whose key is divisible by every, the classes that it aligns with.

    match_id is the smallest key of a class and copies its number of rows, all with the same fingerprint. A query's own class is listed, too. offset is the query's place in the match, in frames.
    common changes how pairs are found, not which."""
    p = cut(prints.where(F.size("fp") > 0).select(F.col(key).alias("id"), "fp"))
    classes = cut(p.groupBy("fp").agg(F.min("id").alias("match_id"), F.count("*").alias("copies")))
    many = classes.select("match_id", F.explode(F.array_distinct("fp")).alias("v")).where(F.col("v") != SILENT).groupBy("v").agg(F.count("*").alias("c")).where(F.col("c") > common)
    many = keep(many.select(F.col("v").alias("_v")))
    many = None if many.isEmpty() else many
    if many is not None:
        classes = often(classes, many)
    tags = [] if many is None else ["often"]
    asked = p.where(F.col("id") % every == 0).select("id", "fp").join(classes.select(F.col("fp").alias("f"), F.col("match_id").alias("class"), *tags), F.col("fp") == F.col("f")).select("id", "class", "fp", *tags)
    heads = asked.select("class", "fp", *tags).distinct()
    entries = lookups(classes, "match_id", many)
    wanted = lookups(heads, "class", many).select("class", F.col("pos").alias("at"), F.col("value").alias("v"))
    # by merge: the planner takes an exploded column for as large as its rows were, and might broadcast it
    shared = entries.join(wanted.hint("merge"), (F.col("value") == F.col("v")) & (F.col("match_id") != F.col("class")))
    votes = shared.groupBy("class", "match_id", (F.col("pos") - F.col("at")).alias("offset")).agg(F.count("*").alias("hits"))
    best = votes.groupBy("class", "match_id").agg(F.max(F.struct("hits", (-F.col("offset")).alias("o"))).alias("b"))
    best = best.select("class", "match_id", (-F.col("b.o")).alias("offset"), F.col("b.hits").alias("hits")).where(F.col("hits") >= min_hits)
    pairs = best.join(heads, "class").join(classes.select("match_id", F.col("fp").alias("g"), "copies", *(F.col(x).alias(f"g_{x}") for x in tags)), "match_id")
    if many is not None:  # those votes lack the common integers
        pairs = pairs.where(~F.arrays_overlap(F.col("often"), F.col("g_often")))
    start, at = F.greatest(F.lit(0), -F.col("offset")), F.greatest(F.lit(0), F.col("offset"))
    overlap = F.least(F.size("fp") - start, F.size("g") - at)
    pairs = pairs.withColumn("overlap", overlap).where(F.col("overlap") >= min_overlap)
    bits = F.zip_with(F.slice("fp", start + 1, F.col("overlap")), F.slice("g", at + 1, F.col("overlap")), lambda a, b: F.bit_count(a.bitwiseXOR(b) .bitwiseAND(F.lit(0xFFFFFFFF))))
    pairs = pairs.withColumn("wrong", F.aggregate(bits, F.lit(0), lambda s, x: s + x.cast("int"))).select("class", "match_id", "copies", "offset", "hits", "overlap", "wrong")
    if many is not None:
        pairs = pairs.union(compared(heads, classes, min_hits, min_overlap, max_bit_error))
    pairs = pairs.withColumn("bit_error", F.round(F.col("wrong") / (32 * F.col("overlap")), 6)).where(F.col("bit_error") <= max_bit_error)
    pairs = pairs.select("class", "match_id", F.col("copies").cast("long"), F.col("offset").cast("int"), F.col("hits").cast("long"), "bit_error")
    own = classes.select(F.col("match_id").alias("class"), "match_id", F.col("copies").cast("long"), F.lit(0).alias("offset"), F.size("fp").cast("long").alias("hits"), F.lit(0.0).alias("bit_error"))
    found = pairs.union(own)
    return asked.select(F.col("id").alias("query_id"), "class").join(found, "class").select("query_id", "match_id", "copies", "offset", "hits", "bit_error")


def melody(vector: list[float] | None, rate: int = 4000, note: int = 256) -> bytes | None:
    """A recording made from a vector: each component is a note, its value the pitch, in quarter steps of the vector's scale."""
    if not vector:
        return None
    v = np.nan_to_num(np.asarray(vector, float))
    step = np.clip(np.round(v / max(1e-9, np.abs(v).mean()) * 6), -18, 18)
    phase = np.cumsum(np.repeat(2 * np.pi * 440 * 2 ** (step / 12) / rate, note))
    return write_wav(0.6 * np.sin(phase) + 0.2 * np.sin(2 * phase), rate)


def recordings(embeddings: DataFrame) -> DataFrame:
    """(vec_id, audio): a WAV column made from the vectors, as the test tables hold no audio."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([melody(x.as_py()) for x in part.column(1)], pa.binary())], ["vec_id", "audio"])

    d = embeddings.select("vec_id", "embedding")
    return d.mapInArrow(run, f"vec_id {d.schema['vec_id'].dataType.simpleString()}, audio binary")
