import random

import pytest

from wickwork.llm import suffix


def found(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("options", [{}, {"hot": 1, "per_shard": 50}, {"length": 40, "gram": 16}])
def test_against_brute_force(documents, corpus, options):
    want = suffix.brute(corpus, options.get("length", 100))
    assert sum(v[1] for v in want.values()) > 1000
    assert found(suffix.dedup(documents, **options)) == want


def test_classes_of_windows():
    r = random.Random(3)
    for _ in range(40):
        base = [bytes(r.choice(b"abc") for _ in range(r.randrange(60))) for _ in range(r.randrange(1, 8))]
        texts = [b"".join(r.choice(base) for _ in range(r.randrange(5))) for _ in range(r.randrange(1, 20))]
        n, seen = r.choice([3, 8, 10, 20]), set()
        for t, got in zip(texts, suffix.repeated_windows(texts, n), strict=True):
            want = [i for i in range(len(t) - n + 1) if t[i : i + n] in seen or seen.add(t[i : i + n])]
            assert got.tolist() == want


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    r = random.Random(1)
    a = "".join(r.choice("abcdefgh ") for _ in range(9000))
    rows = [(0, a), (1, a[100:5000] + a[:3000])]
    monkeypatch.setattr(suffix, "PIECE", 1 << 10)
    assert found(suffix.dedup(spark.createDataFrame(rows, "doc_id long, text string"))) == suffix.brute(dict(rows))


def test_one_line_in_all_documents(spark):
    """A line with other words around it each time: its minimizers have a segment per document, and no shard gets them all."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(7))
    line = " ".join(word() for _ in range(25))
    rows = [(i, " ".join(word() for _ in range(12)) + f" {i} " + line + f" {i} " + " ".join(word() for _ in range(12))) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(50)]  # copies, too
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(suffix.dedup(df, hot=20, per_shard=30)) == suffix.brute(dict(rows))
    base = suffix.packed(df)
    occ = suffix.occurrences(base)
    segs = occ.groupBy("anchor", "seg").agg({"rid": "min", "at": "min"})
    sizes = {r["anchor"]: r["count"] for r in segs.groupBy("anchor").count().collect()}
    assert max(sizes.values()) >= 200  # what one shard would have got
    cold = segs.selectExpr("anchor", "seg", "`min(rid)` AS rid", "`min(at)` AS at").where(~segs["anchor"].isin([a for a, n in sizes.items() if n > 20]))
    found_in = suffix.shard_texts(base, cold, max(1, cold.count() // 30), 100).groupBy("shard").count().collect()
    assert max(x["count"] for x in found_in) <= 20 + 3 * 30


def test_order_of_odd_rows(odd):
    """Of rows with one id the first loses only what it repeats itself, the second copy all; the null id comes last and loses all, too."""
    long = max((r["text"] or "" for r in odd.collect()), key=len)
    alone = suffix.brute({0: long})[0][1]
    got = sorted(((r["doc_id"], r["n_removed"]) for r in suffix.dedup(odd).collect()), key=str)
    assert got == sorted([(0, 0), (1, 0), (1, alone), (1, len(long)), (2, 0), (2, 0), (None, len(long))], key=str) and 0 < alone < len(long)


def test_documents_keep_their_columns(documents, corpus):
    out = suffix.without_repeats(documents)
    assert out.schema == documents.schema
    want, before = suffix.brute(corpus), {r["doc_id"]: r for r in documents.collect()}
    for r in out.collect():
        text = corpus[r["doc_id"]] or ""
        if want[r["doc_id"]][1] == 0:
            assert r["text"] == text and r["n_chars"] == before[r["doc_id"]]["n_chars"]
        else:
            lost = len(text.encode()) - len(r["text"].encode())
            assert r["n_chars"] == len(r["text"]) and want[r["doc_id"]][1] <= lost <= want[r["doc_id"]][1] + 6 * want[r["doc_id"]][2]
        assert all(r[c] == before[r["doc_id"]][c] for c in documents.columns if c not in ("text", "n_chars"))


def test_empty(empty):
    assert suffix.dedup(empty).count() == 0 and suffix.without_repeats(empty).count() == 0
