import random

import numpy as np

from wickwork.llm import simhash as H


def found(df):
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in df.collect()}


def test_against_brute_force(documents, corpus):
    want = H.brute(corpus)
    assert found(H.near_duplicates(documents)) == want
    assert want[40][1] == want[41][1] == 1 and want[46][0] == "0" * 16 and want[47][1] == want[48][1] == 46


def test_tree_finds_every_link(spark):
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = [b ^ np.uint64(1 << int(x)) ^ np.uint64(1 << int(y)) for b in base for x, y in r.integers(0, 63, (3, 2))]
    fps = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    want = {}
    own = np.arange(len(fps))
    link = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    while True:
        new = np.where(link, own[None, :], len(fps)).min(axis=1)
        if (new == own).all():
            break
        own = new
    want = own.tolist()
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    for leaf, sample in ((16, 200), (64, 10_000), (4096, 50)):
        roots = {r["node"]: r["root"] for r in H.components(H.links(nodes, 2, sample=sample, leaf=leaf)).collect()}
        label = [roots.get(int(x), int(x)) for x in fps.view(np.int64)]
        assert len({*zip(want, label, strict=True)}) == len(set(want)) == len(set(label))


def test_dense_shards_are_salted(monkeypatch):
    monkeypatch.setattr(H, "LARGEST_LEAF", 50)
    ball = np.array([0] + [1 << i for i in range(63)] + [3 << i for i in range(62)], np.uint64)
    tree = H.Tree(ball, len(ball), 2, 10)
    where = [set() for _ in ball]
    for shard, rows in tree.route(ball):
        for s, k in zip(shard, rows, strict=True):
            where[k].add(int(s))
    for i in range(len(ball)):
        for j in range(i):
            if (int(ball[i]) ^ int(ball[j])).bit_count() <= 2:
                assert where[i] & where[j]


def test_forest_of_many_blocks():
    r = np.random.default_rng(5)
    fps = np.unique(r.integers(0, 1 << 14, 4000, dtype=np.uint64))
    edges = H._forest(fps, 1)
    parent = list(range(len(fps)))
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent[root(b)] = root(a)
    place = {int(f): i for i, f in enumerate(fps)}
    for f, i in place.items():
        for b in range(14):
            if f ^ 1 << b in place:
                assert root(i) == root(place[f ^ 1 << b])


def test_similar_finds_near_copies(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    texts, group = [], []
    for g in range(25):
        w = [word() for _ in range(300)]
        for c in range(4):
            v = list(w)
            for _ in range(c):
                v[r.randrange(300)] = word()
            texts.append(" ".join(v))
            group.append(g)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = {r["doc_id"]: r["root"] for r in H.similar(df).collect()}
    together = sum(root[i] == root[i - i % 4] for i in range(100))
    assert together >= 98 and len(set(root.values())) >= 25
    kept = sorted(r["doc_id"] for r in H.keep_one(df).collect())
    assert len(kept) <= 27 and set(range(0, 100, 4)) <= set(kept)


def test_keep_one(documents, odd):
    out = H.keep_one(documents)
    assert out.schema == documents.schema
    ids = {r["doc_id"] for r in out.collect()}
    assert {1, 2} <= ids and not ids & {40, 41, 42, 47, 48}
    kept = sorted(((r["doc_id"], r["text"]) for r in H.keep_one(odd).collect()), key=lambda r: (r[0], len(r[1])))
    assert [(i, len(t)) for i, t in kept] == [(0, 0), (1, len("short text")), (1, 369)]  # null ids and later ids of equal texts go


def test_joins_are_never_broadcast(documents):
    for df in (H.keep_one(documents), H.near_duplicates(documents)):
        assert "Broadcast" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_near_copies_come_through_the_tree(spark, monkeypatch):
    """keep_one searches all texts' fingerprints with the tree and tests what it links on the whole sets; that alone joins light edits of long texts, the exact join adds the others."""
    r, texts = random.Random(31), []
    for g in range(20):
        w = some_words(r, 1500)
        near, far = list(w), list(w)
        near[700], far[100:220] = some_words(r, 1)[0], some_words(r, 120)
        texts += [" ".join(w), " ".join(near), " ".join(far), " ".join(some_words(r, 40))]
    seen, links, verified = [], H.links, H._verified
    monkeypatch.setattr(H, "links", lambda nodes, *a, **k: seen.append({x["fp"] for x in nodes.collect()}) or links(nodes, *a, **k))
    tested = []
    monkeypatch.setattr(H, "_verified", lambda *a: tested.append(verified(*a)) or tested[-1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(H, "release", lambda df: None)
    assert sorted(x["doc_id"] for x in H.keep_one(df).collect()) == [i for i, x in enumerate(joined(texts)) if i == x]
    assert len(seen) == 1 and seen[0] == {int(np.uint64(H.fingerprint(t, 5)).astype(np.int64)) for t in texts}
    fp = [H.fingerprint(t, 5) for t in texts]
    close = sum((fp[i] ^ fp[i + 1]).bit_count() <= 2 for i in range(0, 80, 4))
    assert tested[0].count() >= close >= 5


def test_central_texts_join_large_groups(spark):
    """600 copies of a text, each with three words changed: most pairs of them are not similar, all are to the text. The first pass joins them, so that no pairs of all with all are left."""
    r = random.Random(21)
    base = some_words(r, 100)
    texts = [" ".join(base)]
    for _ in range(600):
        w = list(base)
        for k in r.sample(range(5, 95), 2):
            w[k] = some_words(r, 1)[0]
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert len({x["root"] for x in H.similar(df).collect()}) == len(set(joined(texts)))


def test_test_table_against_brute_force(spark):
    """The registered table at 0.01: every group that pairs at 0.8 make, and no other."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    ids = sorted(texts)
    want = joined([H._shingles(texts[i], 5)[0].decode() for i in ids])
    root = {r["doc_id"]: r["root"] for r in H.similar(df).collect()}
    assert len({*zip(want, (root[i] for i in ids), strict=True)}) == len(set(want)) == len(set(root.values()))


def test_edges(empty, odd):
    assert H.near_duplicates(empty).count() == 0 and H.keep_one(empty).count() == 0
    got = H.near_duplicates(odd).collect()
    assert len(got) == 7 and all(r["component_id"] is not None for r in got)


def joined(texts):
    """Components of all pairs with Jaccard similarity of 0.8 and more, by brute force."""
    sets = []
    for t in texts:
        w = t.split()
        sets.append({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    own = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * min(len(a), len(sets[j])) >= 4 * max(len(a), len(sets[j])) and own[i] != own[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                old, new = max(own[i], own[j]), min(own[i], own[j])
                own = [new if x == old else x for x in own]
    return own


def same_groups(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    root = {r["doc_id"]: r["root"] for r in H.similar(df).collect()}
    want = joined(texts)
    got = [root[i] for i in range(len(texts))]
    assert len(set(zip(want, got, strict=True))) == len(set(want)) == len(set(got))
    assert {r["doc_id"] for r in H.keep_one(df).collect()} == {i for i, x in enumerate(want) if i == x}


def some_words(r, n):
    return ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def test_similar_is_exact_about_the_limit(spark):
    """Pairs on both sides of 0.8, many of them within the spread of fingerprints."""
    r, texts = random.Random(11), []
    for g in range(120):
        w = some_words(r, r.choice((60, 150, 300)))
        v, at = list(w), r.randrange(len(w) // 2)
        n = int(len(w) * (0.06 + 0.002 * g / 2))
        v[at : at + n] = some_words(r, n)
        texts += [" ".join(w), " ".join(v)]
    same_groups(spark, texts)


def test_similar_finds_pairs_in_a_frequent_passage(spark):
    """Near copies whose common passage stands in all texts, and a chain of which only neighbours are similar."""
    r = random.Random(12)
    passage, chain, texts = some_words(r, 60), some_words(r, 500), []
    for g in range(150):
        own = some_words(r, 20 if g % 2 else 30)
        new = list(own)
        new[r.randrange(1, len(own) - 1)] = some_words(r, 1)[0]
        texts += [" ".join(passage + own), " ".join(passage + new)]
    texts += [" ".join(chain[i : i + 200]) for i in range(0, 300, 14)]
    same_groups(spark, texts)


def test_similar_finds_short_texts(spark):
    r, texts = random.Random(13), ["one two", "one  Two", "one", "", " \n"]
    for g in range(240):
        w = some_words(r, (5, 12, 15, 20, 25, 30, 40, 60)[g % 8])
        texts += [" ".join(w), " ".join((w[:-1] + ["last"], ["first"] + w[1:], w + ["and", "more"])[g // 8 % 3])]
    same_groups(spark, [t.lower() for t in texts])
