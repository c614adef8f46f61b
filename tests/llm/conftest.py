import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, `_id` long, `_t` long, plan string, size long"


@pytest.fixture(scope="session")
def texts():
    """A small corpus with copies, near copies, shared passages, nulls, empty and long texts."""
    r = random.Random(8)
    word = lambda: "".join(r.choice(("an", "be", "ci", "do", "él", "fu", "ga", "ho")) for _ in range(r.randint(1, 4)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    out = ["\n".join(line(r.randint(4, 30)) for _ in range(r.randint(2, 12))) for _ in range(40)]
    passage = line(60)
    for i in range(0, 12, 3):
        out[i] += "\n" + passage + "\n" + line(5)
    out += [out[1], out[1], out[2]]
    for i in (3, 4, 5):
        w = out[i].split(" ")
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    out += [None, "", " \t\n", "one", "Two words", "MIT\n" + line(20), "x" * 400, "ab " * 300, " ".join(word() for _ in range(6000))]
    return out


@pytest.fixture(scope="session")
def corpus(texts):
    return dict(enumerate(texts))


@pytest.fixture(scope="session")
def documents(spark, texts):
    """The corpus as a table, with columns whose names operators might use themselves."""
    rows = [(i, t, "en", None if i % 10 == 9 else f"src{i % 4 if i % 3 else 0}", None if t is None else len(t), "r", 7, 8, "p", 9) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)


@pytest.fixture(scope="session")
def odd(spark):
    """Repeated rows, a repeated doc_id with another text, and a null doc_id."""
    long = "the quick brown fox jumps over the lazy dog and runs far away from all of the other animals that live in this forest today " * 3
    rows = [(1, long), (1, long), (1, "short text"), (None, long), (2, None), (2, None), (0, "")]
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def rows(df, key="doc_id"):
    return {r[key]: tuple(r) for r in df.collect()}
