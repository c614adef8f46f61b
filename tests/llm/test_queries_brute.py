"""The registered queries that SQL can't follow, on the smallest tables, beside brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from test_chroma import plainly
from test_dom import by_hand
from test_mixing import by_hand as mixed_by_hand
from test_packing import best_fit, check
from tokenizers import Tokenizer

from wickwork.llm import chroma, queries, simhash, suffix

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="module")
def texts(table):
    return {r["doc_id"]: r["text"] for r in table("documents").collect()}


def test_op1(spark, texts):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op1_suffix_array_dedup(spark, SF).collect()}
    assert got == suffix.brute(texts)


def test_op3(spark, table, texts):
    taken, mix, _ = mixed_by_hand(table("documents"), texts)
    got = queries.op3_source_mixing(spark, SF).collect()
    assert {r["doc_id"]: r["taken"] for r in got} == {k: taken.get(k, 0) for k in texts}
    assert sum(r["taken"] for r in got) == pytest.approx(sum(r["size"] for r in got), abs=20)
    per = {}
    for r in got:
        per.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(sum(v) == round(t) for (_, t), v in per.items()) and all(r["taken"] <= 3 * r["size"] for r in got)


def test_op5(spark, texts):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op5_simhash_near_duplicates(spark, SF).collect()}
    assert got == simhash.brute(texts)


def test_op6(spark, table):
    vectors = {r["vec_id"]: r["embedding"] for r in table("embeddings").collect()}
    fps = {k: chroma.fingerprint(chroma.melody(v)) for k, v in vectors.items()}
    classes = {}
    for k, v in sorted(fps.items()):
        classes.setdefault(v.tobytes(), []).append(k)
    heads = {v[0]: fps[v[0]] for b, v in classes.items() if b}
    want = {(q, m) for b, own in classes.items() if b for q in own if q % 100 == 0 for m in {own[0], *(m for _, m in plainly({0: fps[q]} | {i + 1_000_000: x for i, x in heads.items() if i != own[0]}))}}
    got = {(r["query_id"], r["match_id"]) for r in queries.op6_chroma_fingerprints(spark, SF).collect()}
    assert got == {(q, m - 1_000_000 if m >= 1_000_000 else m) for q, m in want}


def test_op7(spark, table):
    pages = {r["page_id"]: r["html"] for r in table("pages").collect()}
    got = queries.op7_html_extraction(spark, SF).collect()
    assert len(got) == len(pages) and all(r["text"] == by_hand(pages[r["page_id"]]) for r in got)


def test_op10(spark, texts):
    got = queries.op10_best_fit_packing(spark, SF).collect()
    check(got, 1024)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for k, text in texts.items():
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] == k)
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        assert own == [(i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert len({r["sequence_id"] for r in got}) <= 1.01 * best_fit([r["length"] for r in got], 1024) + 1
