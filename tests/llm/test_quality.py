import random
import re

import duckdb

from wickwork.llm import quality as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 2000 else {g for g in set(grams) if grams.count(g) > 1}
    covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_base_counts(documents, corpus):
    for r in Q.judge(documents).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(corpus[r["doc_id"]]), r["doc_id"]
        assert r["kept"] is (not r["base_failed"])


def hosts(spark):
    """A menu over many different articles, an article copied as often, near copies, and a page that is nearly all menu."""
    menu = "Home | News | Contact 12"
    rows = []
    for i in range(60):
        rows.append((i, "h", f"{menu}\nArticle number {'abcdefghij'[i % 10] * (i + 3)} tells of things that no other one here tells of, at some length.\nMore of {chr(97 + i % 26) * (i + 2)} here."))
        rows.append((100 + i, "h", "A copied article has lines that stand in many documents, which is fine for this rule.\nIts second line, too, of some words."))
        rows.append((200 + i, "h", f"A near copy has a long line that all the near copies have in common, word for word, to the end.\nIt has another one that they share as well, for copies agree in most lines.\nAnd one small line {i * 'y'} of its own."))
    rows += [(300, "h", f"{menu}\n{menu}\n{menu} \n{menu}\nnine ten eleven twelve"), (301, "other", f"{menu}\nten words stand here so that base rules let it pass"), (302, None, None)]
    return spark.createDataFrame([(i, t, h, 1) for i, h, t in rows], "doc_id long, text string, source string, bad long"), {i: t for i, _, t in rows}, menu


def test_lines(spark):
    df, texts, menu = hosts(spark)
    got = {r["doc_id"]: r for r in Q.judge(df, share=0.05).collect()}
    assert all(got[i]["n_removed_chars"] == len(menu) for i in range(60)) and all(got[i]["kept"] for i in range(60))
    assert all(got[i]["n_removed_chars"] == 0 and got[i]["kept"] for i in (*range(100, 160), *range(200, 260)))
    assert not got[300]["kept"] and got[301]["kept"] and got[301]["n_removed_chars"] == 0 and not got[302]["kept"]
    out = {r["doc_id"]: r["text"] for r in Q.filter_documents(df, share=0.05).collect()}
    assert set(out) == {i for i, r in got.items() if r["kept"]}
    assert out[5] == texts[5].split("\n", 1)[1] and out[120] == texts[120]
    assert Q.filter_documents(df, share=0.05).schema == df.schema


def test_sql(spark):
    df, _, _ = hosts(spark)
    documents = df.toPandas()
    want = duckdb.sql(Q.SQL).fetchall()
    names = duckdb.sql(Q.SQL).columns
    ours = sorted(map(str, ([r[n] for n in names] for r in Q.judge(df).collect())))
    assert documents is not None and ours == sorted(map(str, map(list, want)))


def test_a_menu_over_articles_of_which_one_is_copied_often(spark):
    """500 articles with a menu; one more with it stands there 501 times. Then 300 pages with two legal lines that are longer than any line of theirs."""
    menu = "Home | News | Contact"
    legal = ["All rights are reserved by the owners of this site, whose terms of use you have read, understood and accepted by looking at it", "Each price on our pages includes taxes, while the cost of sending goods to your country is added when an order is placed"]
    rows = [(i, f"{menu}\nAn article about {'xyz'[i % 3] * (i + 1)}, number {chr(97 + i % 26)}, with words that no other one of them has.") for i in range(500)]
    rows += [(1000 + i, f"{menu}\nThe article that was copied so often that it outnumbers all of the others.") for i in range(501)]
    df = spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id long, text string, source string")
    more = [(5000 + i, "\n".join((legal[0], f"What stands here is about {chr(97 + i % 26) * (i // 26 + 2)} and nothing else in all the world.", f"There is more of {chr(97 + i % 26) * (i // 26 + 3)} to be told on some other day, when all of us have the time for it.", legal[1], menu)), "b") for i in range(300)]
    df = df.union(spark.createDataFrame(more, df.schema))
    got = {r["doc_id"]: r for r in Q.judge(df).collect()}
    assert all(r["n_removed_chars"] == len(menu) and r["kept"] for i, r in got.items() if i < 5000)
    assert all(r["n_removed_chars"] == len(menu) + sum(map(len, legal)) and r["kept"] for i, r in got.items() if i >= 5000)
    out = {r["doc_id"]: r["text"] for r in Q.filter_documents(df).collect()}
    assert out[1003] == rows[503][1].split("\n")[1] and out[5007] == "\n".join(more[7][1].split("\n")[1:3])


def test_near_copies_keep_their_lines(spark):
    """1,000 near copies of a text of eight lines, a word changed in one of them or in two: whatever line it is, none goes."""
    name = "abcdefgh"
    lines = [" ".join([f"{name[k]}{name[j]}ne" for j in range(k % 3 + 4)] + ["words"] + [f"{name[j]}{name[k]}da" for j in range(k % 2 + 5)]) for k in range(8)]
    rows = []
    for i in range(1000):
        own = list(lines)
        for k in {i % 8, i // 8 % 8}:
            own[k] = own[k].replace("words", f"w{chr(97 + i % 26)}{chr(97 + i // 26)}")
        rows.append((i, "\n".join(own), "s"))
    rows += [(2000 + i, f"Text {chr(97 + i % 26) * (i + 2)} has nothing in common with any other text on this host, or so they say.", "s") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {(r["n_removed_chars"], r["kept"]) for r in Q.judge(df).collect()} == {(0, True)}


def test_depleted_documents_go(spark):
    rows = [(i, f"The same first line on each page\nand then an article about {chr(97 + i % 26) * (i + 2)} that goes on for many more words than the first line has", None) for i in range(30)]
    rows += [(100, "The same first line on each page\nTHE SAME FIRST LINE ON EACH PAGE \nand few more", None), (101, "The same first line on each page\nand few more", "elsewhere")]
    df = spark.createDataFrame([*rows, rows[0], (None, *rows[1][1:])], "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["n_removed_chars"], r["kept"]) for r in Q.judge(df).collect()}
    assert got.pop(100) == (64, False) and got.pop(101) == (0, True) and set(got.values()) == {(32, True)} and len(got) == 31
    kept = Q.filter_documents(df).collect()
    assert len(kept) == 33 and all(r["text"].startswith("and") for r in kept if r["source"] is None) and sum(r["doc_id"] is None for r in kept) == 1


def test_long_texts(spark):
    r = random.Random(9)
    long = "\n".join(" ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(r.randint(0, 40))) for _ in range(2000))
    one = " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(60_000))
    df = spark.createDataFrame([(0, long, "s"), (1, one, "s"), (2, "x" * 300_000, "s"), (3, "a b " * 50_000, "s")], "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in Q.judge(df).collect()}
    for i, t in ((0, long), (1, one), (2, "x" * 300_000)):
        w = t.split()
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["kept"]) == (len(w), sum(map(len, w)), i < 2)
    assert got[3]["n_repeat_words"] == got[3]["n_words"] == 100_000 and not got[3]["kept"]
    assert {r["doc_id"]: r["text"] for r in Q.filter_documents(df).collect()} == {0: long, 1: one}


def test_edges(empty, odd, documents):
    for df in (empty, empty.drop("n_chars")):
        assert Q.judge(df).count() == 0 and Q.filter_documents(df).count() == 0 and Q.filter_documents(df).columns == df.columns
    got = sorted(Q.judge(odd).collect(), key=str)
    words = len("the quick brown fox jumps over the lazy dog and runs far away from all of the other animals that live in this forest today".split()) * 3
    assert sorted((str(r["doc_id"]), r["n_words"], r["kept"]) for r in got) == [("0", 0, False), ("1", 2, False), ("1", words, False), ("1", words, False), ("2", 0, False), ("2", 0, False), ("None", words, False)]
    assert Q.filter_documents(documents).schema == documents.schema


def test_native(documents):
    for df in (Q.judge(documents), Q.filter_documents(documents)):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
