"""run() beside the same stages in plain Python, on a small table."""

from test_simhash import joined

import corpus_pipeline as pipeline
from wickwork.llm import mixing, quality, simhash, suffix


def test_stages(spark, documents, corpus, tmp_path):
    table = documents.select("doc_id", "text", "lang", "source", "n_chars")
    table.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in pipeline.STAGES:
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = stage(spark, spark.read.parquet(f"{tmp_path}/{name}"), str(tmp_path))
        seen.append(docs)
        if name != "packed_sequences":
            assert docs.columns == columns and docs.schema == table.schema
    kept = {r["doc_id"] for r in quality.judge(table).collect() if r["kept"]}
    assert {r["doc_id"] for r in seen[0].collect()} == kept
    near = {r["doc_id"]: r["text"] for r in seen[1].collect()}
    left = {r["doc_id"]: r["text"] for r in seen[0].collect()}
    groups = joined([simhash._shingles(left[i], 5)[0].decode() for i in sorted(left)])
    assert set(near) == {i for k, i in enumerate(sorted(left)) if groups[k] == k} and not set(near) & {40, 41, 42}
    plain = suffix.brute(near)
    lost = {r["doc_id"]: len(near[r["doc_id"]].encode()) - len(r["text"].encode()) for r in seen[2].collect()}
    assert all(plain[k][1] <= n <= plain[k][1] + 6 * plain[k][2] for k, n in lost.items()) and set(lost) == set(near)
    taken = {r["doc_id"]: r["taken"] for r in mixing.Mix(seen[2]).result().collect()}
    words = {}
    for r in seen[3].collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {k: n for k, n in taken.items() if n}
    run = pipeline.run(spark, str(tmp_path))
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, run.collect())) == sorted(map(key, seen[4].collect()))


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "source_mix", "packed_sequences"]
    assert pipeline.ORACLE_SQL is None
