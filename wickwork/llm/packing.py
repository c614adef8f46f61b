"""Sum-of-squares packing of tokenised documents into sequences.

A document is the ids of its text and an end id. Only documents over the capacity are cut, all pieces but the first
being full; so each document leaves one piece that shares a sequence, and the full ones are sequences by themselves
and never shuffled. The rest is dealt into shards of at most ``per_shard`` pieces. A shard places its pieces,
longest first, in the open bin that makes the sum over gaps of the squared count of open bins with that gap smallest
(Csirik et al., "On the sum-of-squares algorithm for bin packing"); a bin without gap is closed and counts nothing.
A new bin is opened only where no open one has room: with the choice free, as in the online algorithm, the bins left
open at the end cost 1.5 % more sequences.

A null text counts as empty: one piece with the end id alone. Rows repeat in the result as in the input, and a null
doc_id is kept. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.llm.common import cut

CAPACITY, END, PER_SHARD = 1024, 2, 50_000


@lru_cache(2)
def encoder(path: str):
    """text -> ids (uint32) by the byte-level BPE in path.

    tiktoken merges by the rank of the merged token; in this file ids are those ranks, so the ids are the file's own.
    Texts that hold a special token's string go through the tokenizers library.
    """
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*plain}))}
    special = [x["content"] for x in spec["added_tokens"]]
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for k, text in enumerate(b.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                rows += [(k, i, x, y - x, zlib.crc32(ids[x:y].tobytes())) for i, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False))]
            k, i, x, n, crc = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 5
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(k)), pa.array(i.astype(np.int32)), pa.array(x), pa.array(n), pa.array(crc)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def place(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length, in the given order."""
    gaps = np.arange(capacity + 1)
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = [], [], 0
    none = np.iinfo(np.int64).max
    for n in lengths:
        after = gaps[n:] - n
        cost = np.where(count[n:] > 0, -2 * count[n:] + 1 + np.where(after > 0, 2 * count[: capacity + 1 - n] + 1, 0), none)
        k = int(np.argmin(cost))
        g = n + k if cost[k] < none else capacity
        if g == capacity:
            b, made = made, made + 1
        else:
            b = open_bins[g].pop()
            count[g] -= 1
        bins.append(b)
        offsets.append(capacity - g)
        if g > n:
            open_bins[g - n].append(b)
            count[g - n] += 1
    return bins, offsets


def pack(documents: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, per_shard: int = PER_SHARD) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    all_pieces = cut(pieces(documents, path, capacity, end)).withColumn("row", F.monotonically_increasing_id())
    full = all_pieces.where(F.col("length") == capacity)
    rest = all_pieces.where(F.col("length") < capacity)
    shards = max(1, -(-rest.count() // per_shard))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row"], ascending=[False, True])
        bins, offsets = place(pdf["length"].tolist(), capacity)
        base = int(pdf["shard"].iloc[0]) << 32
        return pdf.assign(sequence_id=[2 * (base + b) for b in bins], offset=offsets)[names]

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    schema = ", ".join(f"`{n}` {rest.schema[n].dataType.simpleString() if n in rest.columns else 'long'}" for n in names)
    packed = rest.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).groupBy("shard").applyInPandas(run, schema)
    alone = full.withColumns({"sequence_id": 2 * F.col("row") + 1, "offset": F.lit(0).cast("long")}).select(*names)
    return packed.unionByName(alone)
