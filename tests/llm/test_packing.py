import zlib
from bisect import bisect_left, insort

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wickwork.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_fit(lengths, capacity):
    bins, gaps = 0, []
    for n in sorted(lengths, reverse=True):
        i = bisect_left(gaps, n)
        if i == len(gaps):
            bins, g = bins + 1, capacity
        else:
            g = gaps.pop(i)
        if g > n:
            insort(gaps, g - n)
    return bins


def check(got, capacity):
    for s in {r["sequence_id"] for r in got}:
        own = sorted((r["offset"], r["length"]) for r in got if r["sequence_id"] == s)
        at = 0
        for o, n in own:
            assert o == at
            at += n
        assert at <= capacity


@pytest.mark.parametrize(("capacity", "per_shard"), [(1024, 50_000), (64, 20)])
def test_pieces(documents, corpus, capacity, per_shard):
    got = P.pack(documents, PATH, capacity=capacity, per_shard=per_shard).collect()
    check(got, capacity)
    t = Tokenizer.from_file(PATH)
    for k, text in corpus.items():
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] == k)
        assert [x[0] for x in own] == list(range(len(own))) and sum(x[2] for x in own) == len(ids)
        assert all(x[2] == capacity for x in own[1:])
        for _, start, n, crc in own:
            assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())


def test_few_sequences():
    r = np.random.default_rng(1)
    for lengths in (r.integers(1, 1024, 3000).tolist(), (1 + r.exponential(200, 3000).astype(int) % 1023).tolist()):
        lengths = sorted(lengths, reverse=True)
        bins, offsets = P.place(lengths)
        assert max(bins) + 1 <= 1.01 * best_fit(lengths, 1024) + 1


def plain_sum_of_squares(lengths, capacity):
    """(bin, offset) of each length: every open bin that has room is tried, and the sum over gaps of squared counts of open bins added up anew."""
    gaps, out = [], []  # gap of each bin; 0 is closed
    order = []  # bins in the order in which they got their gap
    for n in lengths:
        best = None
        for g in sorted({x for x in gaps if x >= n}):
            after = list(gaps)
            after[max(b for b in range(len(gaps)) if gaps[b] == g)] = g - n
            squares = sum(after.count(x) ** 2 for x in set(after) if x)
            if best is None or squares < best[0]:
                best = (squares, g)
        if best is None:
            b, g = len(gaps), capacity
            gaps.append(capacity)
        else:
            g = best[1]
            b = next(b for b in reversed(order) if gaps[b] == g)
            order.remove(b)
        out.append((b, capacity - g))
        gaps[b] = g - n
        order.append(b)
    return out


@pytest.mark.parametrize("capacity", [20, 100, 64])
def test_rule(capacity):
    r = np.random.default_rng(capacity)
    for k in range(15):
        lengths = r.integers(1, capacity if k % 2 else capacity // 2, 60).tolist()
        lengths = sorted(lengths, reverse=True) if k % 3 else lengths
        assert list(zip(*P.place(lengths, capacity), strict=True)) == plain_sum_of_squares(lengths, capacity)


def test_the_rule_prefers_a_crowded_gap():
    """After 50, 40, 40 the gaps are 50 and 20, of one bin each, both with a 40; a 20 fits either: it closes the bin of gap 20, which leaves fewer squares."""
    assert P.place([50, 40, 40, 20], 100) == ([0, 0, 1, 1], [0, 50, 0, 40])


def test_special_strings_and_languages():
    t, encode = Tokenizer.from_file(PATH), P.encoder(PATH)
    for text in ("a<|endoftext|>b", "naïve – Überfluß　日本語  \n\n x's 12345", " \t ", "\u0000​"):
        assert encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_edges(empty, odd):
    assert P.pack(empty, PATH).count() == 0
    got = P.pack(odd, PATH).collect()
    assert len(got) == 7
    check(got, 1024)
