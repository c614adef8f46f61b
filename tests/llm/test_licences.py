import textwrap

import pytest

from wickwork.llm import licences as L


def brute(text, templates=L.TEMPLATES, t=L.THRESHOLD):
    """Every passage that begins and ends with a bigram of the template, one by one."""
    w = L.words_of(text or "")
    pairs = list(zip(w, w[1:], strict=False))
    best = []
    for k, v in templates.items():
        b = set(L.template_bigrams(v))
        longest = int((len(L.words_of(v)) - 1) * (2 - t) / t + 1e-9)
        if len(b & set(pairs)) * (2 - t) < len(b) * t - 1e-9:
            continue
        found = []
        for i, x in enumerate(pairs):
            if x in b:
                for j in range(i, min(len(pairs), i + longest)):
                    if pairs[j] in b:
                        inside = pairs[i : j + 1]
                        shared = len(b & set(inside))
                        dice = 2 * shared / (shared + sum(p not in b for p in inside) + len(b))
                        if dice >= t - 1e-12:
                            found.append((-dice, i, i - j - 1))
        if found:
            d, i, n = min(found)
            best.append((d, -len(b), k, i, n))
    if not best:
        return (0, None, None, None, None)
    d, _, k, i, n = min(best)
    return (len(best), k, round(-d, 6), i, 1 - n)


CODE = "\n".join(f"int value_{i} = compute(value_{i - 1}, {i});  // step {i} of the many" for i in range(1, 61))


def scanned(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r["doc_id"]: tuple(r)[1:] for r in L.scan(df).collect()}


def test_against_brute_force(spark, corpus, documents):
    more = {
        1000: "Intro\nReleased under the MIT License.\nLicensed under the Apache License, Version 2.0!\nend",
        1001: L.TEMPLATES["GPL-3.0-header"].replace("GNU", "our", 1).replace(" and/or ", "\n"),
        1002: "licensed UNDER   cc by-nc (4.0)",
        1003: "Released under the new and changed MIT License of today.",
        1004: "mit " * 5000,
        1005: "under the mit license " * 40,
        1006: L.TEMPLATES["MIT-text"] + " " + L.TEMPLATES["MIT-text"].replace("Software", "Program"),
    }
    extra = spark.createDataFrame(list(more.items()), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in L.scan(documents.select("doc_id", "text").union(extra)).collect()}
    assert got == {k: brute(t) for k, t in (corpus | more).items()}
    assert got[1002][1:3] == ("CC-BY-NC-4.0", 1.0) and got[1000][0] == 2 and got[1001][1] == "GPL-3.0-header"


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
def test_wrapped_notices_within_a_file(spark, mark):
    """Each template wrapped at 72 columns, with comment marks, above 60 lines of code, with an own copyright line, and short ones at the end of a long line."""
    names = sorted(L.TEMPLATES)
    wrap = lambda t: "\n".join(mark + x for x in textwrap.wrap(t, 72))
    texts = {i: f"{mark}Copyright (c) 2024 Some One\n{wrap(L.TEMPLATES[k])}\n\n{CODE}" for i, k in enumerate(names)}
    texts |= {100 + i: "A long line of prose goes on for a while, and then it ends like this: " + L.TEMPLATES[k] for i, k in enumerate(names)}
    got = scanned(spark, texts)
    for i, k in enumerate(names):
        for at in (i, 100 + i):
            assert got[at][1] == k and got[at][2] > 0.99, (k, got[at])
            assert got[at][4] - len(L.words_of(L.TEMPLATES[k])) in (0, 1)  # "this: Permission" is a bigram of ISC


def test_what_is_no_licence(spark):
    texts = {0: CODE, 1: "The rights of any person to use, copy and sell this software are the subject of the following conditions of a license in the public domain." * 3, 2: "licence " * 10_000 + "under the", 3: None, 4: "", 5: "MIT", 6: "x" * 200_000}
    assert {v for v in scanned(spark, texts).values()} == {(0, None, None, None, None)}


def test_long_texts(spark):
    far = " ".join(f"w{i}" for i in range(40_000))
    often = (L.TEMPLATES["ISC"] + " and so on ") * 150
    got = scanned(spark, {0: f"{far} {L.TEMPLATES['Zlib']} {far}", 1: often})
    assert got[0][1:] == ("Zlib", 1.0, 40_000, len(L.words_of(L.TEMPLATES["Zlib"]))) and got[1][1:3] == ("ISC", 1.0) and got[1][3] == 0


def test_edges(odd, empty):
    assert L.scan(empty).count() == 0
    assert {r["n_matches"] for r in L.scan(odd).collect()} == {0} and L.scan(odd).count() == 7


def test_native(documents):
    plan = L.scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
