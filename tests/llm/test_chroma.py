import numpy as np

from wickwork.llm import chroma as C


def sound(seed, seconds=6.0, rate=4000):
    r = np.random.default_rng(seed)
    pitch = np.repeat(440 * 2 ** (r.integers(-12, 12, int(seconds * 10)) / 12), rate // 10)
    return 0.5 * np.sin(np.cumsum(2 * np.pi * pitch / rate))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, audio binary, value int, fp int")


def test_noise_changes_few_bits():
    a = sound(1)
    b = a + np.random.default_rng(2).normal(0, 0.03, len(a))
    x, y = C.fingerprint(C.write_wav(a, 4000)), C.fingerprint(C.write_wav(b, 4000))
    assert len(x) == len(y) > 100
    assert np.bitwise_count(x ^ y).mean() / 32 < 0.05 < 0.3 < np.bitwise_count(x ^ C.fingerprint(C.write_wav(sound(3), 4000))[: len(x)]).mean() / 32


def test_integral_image_against_sums():
    image = C.chroma(sound(4), 4000)
    assert np.allclose(np.linalg.norm(image, axis=1), 1)
    kinds = C.filters()
    assert len(kinds) == 16 and all(c + min(h, 12 - c) <= 12 and w <= C.WIDTH for _, c, h, w in kinds)


def test_silence_joins_nothing(spark):
    quiet = np.zeros(4000 * 6)
    assert set(C.fingerprint(C.write_wav(quiet, 4000)).tolist()) == {C.SILENT}
    rows = [(100 * i, C.write_wav(np.concatenate([quiet, sound(i)]), 4000), 0, 0) for i in range(4)]
    got = C.search(C.fingerprints(frame(spark, rows), "id", "audio"), "id").collect()
    assert all(r["query_id"] == r["match_id"] for r in got) and len(got) == 4


def test_search_aligns(spark):
    a, rate = sound(5, 8), 4000
    noise = np.random.default_rng(1).normal(0, 0.02, len(a))
    rows = [(100, C.write_wav(a, rate)), (1, C.write_wav(a[62 * 128 :], rate)), (2, C.write_wav(a + noise, rate)), (3, C.write_wav(a, rate)), (4, C.write_wav(sound(6, 8), rate)), (5, None), (6, b"junk"), (7, C.write_wav(a[:100], rate)), (None, C.write_wav(sound(7), rate))]
    prints = C.fingerprints(frame(spark, [(i, x, 0, 0) for i, x in rows]), "id", "audio")
    got = {r["match_id"]: r for r in C.search(prints, "id").collect()}
    assert set(got) == {1, 2, 3}
    assert got[3]["copies"] == 2 and got[3]["bit_error"] == 0 and got[2]["offset"] == 0 and 0 < got[2]["bit_error"] < 0.1
    assert got[1]["offset"] == -62 and got[1]["bit_error"] < 0.1


def test_recall_against_brute_force(spark):
    r = np.random.default_rng(9)
    rows, n = [], 40
    for i in range(n):
        a = sound(i)
        rows += [(100 * i, C.write_wav(a, 4000)), (100 * i + 1, C.write_wav(a + r.normal(0, 0.05 + 0.01 * (i % 5), len(a)), 4000))]
    prints = C.fingerprints(frame(spark, [(i, x, 0, 0) for i, x in rows]), "id", "audio")
    fp = {r["id"]: np.array(r["fp"], np.int32).view(np.uint32) for r in prints.collect()}
    want = {(q, m) for q in fp if q % 100 == 0 for m in fp if m != q and np.bitwise_count(fp[q] ^ fp[m]).mean() / 32 <= C.MAX_BIT_ERROR}
    got = {(r["query_id"], r["match_id"]) for r in C.search(prints, "id").collect() if r["query_id"] != r["match_id"]}
    assert len(want & got) >= 0.9 * len(want) >= 30 and not {(q, m) for q, m in got if q // 100 != m // 100}


def plainly(fps, every=100):
    """(query, match, offset, hits, bit error) of different recordings, from all pairs of frames."""
    out = {}
    for q, a in fps.items():
        if q % every:
            continue
        for m, b in fps.items():
            if m == q or len(a) == 0 or len(b) == 0:
                continue
            votes = {}
            for i, x in enumerate(a):
                for j in np.flatnonzero(b == x):
                    if x != C.SILENT:
                        votes[j - i] = votes.get(j - i, 0) + 1
            if not votes or max(votes.values()) < C.MIN_HITS:
                continue
            offset = min(o for o, n in votes.items() if n == max(votes.values()))
            i, j = max(0, -offset), max(0, offset)
            n = min(len(a) - i, len(b) - j)
            if n >= C.MIN_OVERLAP:
                error = int(np.bitwise_count(a[i : i + n] ^ b[j : j + n]).sum()) / (32 * n)
                if error <= C.MAX_BIT_ERROR:
                    out[q, m] = (int(offset), votes[offset], round(error, 6))
    return out


def prints_of(spark, recordings):
    prints = C.fingerprints(frame(spark, [(i, C.write_wav(x, 4000), 0, 0) for i, x in recordings.items()]), "id", "audio")
    return prints, {r["id"]: np.array(r["fp"], np.int32).view(np.uint32) for r in prints.collect()}


def test_alignments_against_brute_force(spark):
    r, recordings = np.random.default_rng(4), {}
    for k in range(12):
        a = sound(50 + k, 8)
        cut = int(r.integers(1, 40)) * 128
        recordings |= {100 * k: a, 100 * k + 1: a[cut:] + r.normal(0, 0.03, len(a) - cut), 100 * k + 2: np.concatenate([sound(90 + k, 2), a[: 4000 * 5]]) + 0.01 * r.normal(size=4000 * 7)}
    prints, fps = prints_of(spark, recordings)
    got = {(x["query_id"], x["match_id"]): (x["offset"], x["hits"], x["bit_error"]) for x in C.search(prints, "id").collect() if x["query_id"] != x["match_id"]}
    assert got == plainly(fps) and len(got) >= 20


def test_a_common_tone(spark):
    """Recordings that begin with one and the same tone, and then differ; those that go on alike are found, and the tone alone makes few pairs."""
    tone, recordings = 0.5 * np.sin(2 * np.pi * 440 * np.arange(4000 * 3) / 4000), {}
    for k in range(30):
        a = np.concatenate([tone[: 4000 + 300 * (k % 7)], sound(200 + k, 7)])
        recordings |= {100 * k: a, 100 * k + 1: a + np.random.default_rng(k).normal(0, 0.02, len(a))}
    prints, fps = prints_of(spark, recordings)
    want = plainly(fps)
    for common in (1000, 8):
        got = {(x["query_id"], x["match_id"]) for x in C.search(prints, "id", common=common).collect() if x["query_id"] != x["match_id"]}
        assert len(got & {*want}) >= 0.9 * len(want) >= 25 and got <= {*want}
    values = prints.selectExpr("explode(array_distinct(fp)) AS _v").groupBy("_v").count().where("count > 8").select("_v")
    pairs = lambda some: sum(x["count"] ** 2 for x in C.lookups(prints, "id", some).groupBy("value").count().collect())
    assert not values.isEmpty() and pairs(values) < 0.8 * pairs(None)


def test_common_integers_lose_nothing(spark, monkeypatch):
    """Copies whose tones are common to all recordings: wherever the line for common integers is drawn, and however small the blocks, the pairs are those of brute force, with their offsets and hits."""
    tones = [0.5 * np.sin(2 * np.pi * 440 * 2 ** (k / 12) * np.arange(3000) / 4000) for k in (0, 3, 7)]
    recordings, r = {}, np.random.default_rng(8)
    for k in range(24):
        a = np.concatenate([tones[i][: 900 + 64 * int(r.integers(0, 30))] for i in r.permutation(3)] + [sound(300 + k, 1 + k % 3)])
        recordings |= {100 * k: a, 100 * k + 1: a + r.normal(0, 0.002 * (1 + k % 4), len(a)), 100 * k + 2: np.concatenate([sound(400 + k, 0.5), a])}
    prints, fps = prints_of(spark, recordings)
    want = plainly(fps)
    assert len(want) >= 40
    for common, frames, cells in ((1000, 1 << 18, 1 << 20), (8, 1 << 18, 1 << 20), (8, 500, 1000), (0, 1 << 18, 1 << 20)):
        monkeypatch.setattr(C, "TASK_FRAMES", frames, raising=False)
        monkeypatch.setattr(C, "CELLS", cells, raising=False)
        got = {(x["query_id"], x["match_id"]): (x["offset"], x["hits"], x["bit_error"]) for x in C.search(prints, "id", common=common).collect() if x["query_id"] != x["match_id"]}
        assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}, common
        assert all(abs(got[k][2] - want[k][2]) < 2e-6 for k in want)


def test_repeated_ids_with_other_audio(spark):
    rows = [(100, C.write_wav(sound(1), 4000), 0, 0), (100, C.write_wav(sound(2), 4000), 0, 0), (7, C.write_wav(sound(2), 4000), 0, 0), (100, C.write_wav(sound(1), 4000), 0, 0)]
    got = sorted((r["query_id"], r["match_id"], r["copies"]) for r in C.search(C.fingerprints(frame(spark, rows), "id", "audio"), "id").collect())
    assert got == [(100, 7, 2), (100, 100, 2), (100, 100, 2)]


def test_vectors_as_recordings(spark):
    df = spark.createDataFrame([(0, [0.1, -0.2, 0.3] * 20), (1, [0.1, -0.2, 0.3] * 20), (2, None), (3, [])], "vec_id long, embedding array<float>")
    got = C.search(C.fingerprints(C.recordings(df), "vec_id", "audio"), "vec_id").collect()
    assert [(r["query_id"], r["match_id"], r["copies"]) for r in got] == [(0, 0, 2)]
    assert C.search(C.fingerprints(C.recordings(df.limit(0)), "vec_id", "audio"), "vec_id").count() == 0
