import numpy as np
import pytest

from wickwork.llm import mixing as M


def brute_targets(sizes, weights, repeats=3):
    lo, hi = 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(repeats * s, mid * w) for s, w in zip(sizes, weights, strict=True)) < sum(sizes) else (lo, mid)
    return [min(repeats * s, hi * w) for s, w in zip(sizes, weights, strict=True)]


@pytest.mark.parametrize("sizes", [[100, 1000, 10], [5, 5, 5000], [0, 0, 3], [1], [], [7, 7, 7, 900, 1, 2]])
def test_targets(sizes):
    w = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    assert M.targets(sizes, w) == pytest.approx(brute_targets(sizes, w), abs=1e-6)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permutation(n):
    there = M.permuted(np.arange(n), n, 5)
    assert sorted(there.tolist()) == list(range(n)) and M.permuted(there, n, 5, inverse=True).tolist() == list(range(n))


def test_quotas():
    """Slots one by one, as many as it takes."""
    for size in (1, 10, 64, 65, 1000, 1027):
        for goal in sorted({1, size // 3, size - 1, size, size + 1, 2 * size - 5, 3 * size}):
            if 0 < goal <= 3 * size:
                q, last, words = M.quotas(size, goal, 64, 7, 3)
                n, held = -(-size // 64), []
                for j in range(q):
                    k = int(M.permuted(np.array([j % n]), n, M._key(7, 3, j // n))[0])
                    held.append(min(64, size - 64 * k))
                assert k == last and 0 < words <= held[-1] and sum(held[:-1]) + words == goal
    assert M.quotas(0, 0, 64, 7, 3)[0] == 0


def by_hand(documents, corpus, **options):
    """taken, from a stream of words per source and the slots one by one."""
    mix = M.Mix(documents, **options)
    stream = mix.streams().collect()
    slots = mix.slots().collect()
    taken = {}
    for sid in {r["sid"] for r in stream}:
        own = sorted((r for r in stream if r["sid"] == sid and r["size"]), key=lambda r: r["start"])
        words = [r["doc_id"] for r in own for _ in range(r["size"])]
        assert [r["start"] for r in own] == [words.index(r["doc_id"]) for r in own]
        for s in slots:
            if s["sid"] == sid:
                for d in words[s["block"] * mix.block : (s["block"] + 1) * mix.block][: s["words"]]:
                    taken[d] = taken.get(d, 0) + 1
    return taken, mix, slots


def test_against_slots(documents, corpus):
    taken, mix, slots = by_hand(documents, corpus, block=16, shard_slots=32)
    got = mix.result().collect()
    assert {r["doc_id"]: r["taken"] for r in got} == {k: taken.get(k, 0) for k in corpus}
    assert all(r["size"] == len((corpus[r["doc_id"]] or "").split()) and r["taken"] <= 3 * r["size"] for r in got)
    per = {}
    for r in got:
        per.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(sum(v) == round(t) for (_, t), v in per.items())
    seen = [(s["sid"], s["pass"], s["block"]) for s in slots]
    assert len(seen) == len(set(seen))  # a pass takes a block once
    assert sorted(map(tuple, M.Mix(documents, block=16, shard_slots=32).result().collect())) == sorted(map(tuple, got))


def test_documents(documents, corpus):
    mix = M.Mix(documents, block=16)
    out = mix.documents(documents)
    assert out.schema == documents.schema
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == {r["doc_id"]: r["taken"] for r in mix.result().collect() if r["taken"]}


def test_cut_out():
    assert M.cut_out(" a  b\nc d e", [(0, 1), (1, 3), (4, 5)]) == "a  b\nc\ne"


def test_small_sources(spark):
    """Sources of a few words, far below a block, take their targets, too."""
    rows = [(i, "w " * (i % 4 + 1), f"s{i % 7}") for i in range(28)] + [(100, "much " * 3000, "t"), (101, None, "u"), (102, " ", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, of = M.Mix(df).result().collect(), {r[0]: r[2] for r in rows}
    per = {}
    for r in got:
        per.setdefault((of[r["doc_id"]], r["target"]), []).append(r["taken"])
    assert len(per) == 10 and all(sum(v) == round(t) for (_, t), v in per.items()) and sum(len(v) for v in per.values()) == 31
    out = M.Mix(df).documents(df).collect()
    assert {(r["doc_id"]): sum(len(x["text"].split()) for x in out if x["doc_id"] == r["doc_id"]) for r in got} == {r["doc_id"]: r["taken"] for r in got}


def test_edges(odd, empty):
    assert M.Mix(empty).result().count() == 0 and M.Mix(empty).documents(empty).count() == 0
    got = M.Mix(odd).result().collect()
    sizes = sorted(r["size"] for r in got)
    assert len(got) == 7 and sizes[:4] == [0, 0, 0, 2] and sum(r["taken"] for r in got) == round(got[0]["target"]) == sum(sizes)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    out = M.Mix(odd).documents(odd).collect()
    assert sum(len(r["text"].split()) for r in out) == sum(sizes)


@pytest.mark.parametrize("lang", ["es"])
def test_extra_columns_stay(documents, lang):
    out = M.Mix(documents).documents(documents.withColumn("lang", __import__("pyspark").sql.functions.lit(lang)))
    assert {r["lang"] for r in out.select("lang").distinct().collect()} == {lang}
