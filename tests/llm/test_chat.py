import random

from wickwork.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, j long, part int"


def brute(rows):
    convs = {}
    for c, turn, role, text in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    keep = {}
    for c, t in convs.items():
        others = [(d, u) for d, u in convs.items() if d != c]
        if any(len(u) > len(t) and u[: len(t)] == t for _, u in others) or any(u == t and d is not None and (c is None or d < c) for d, u in others):
            continue
        keep[c] = "".join(f"<|{r}|>\n{x}<|end|>\n" for r, x in t)
    return keep


def rows():
    r = random.Random(2)
    out = []
    for c in range(30):
        base = random.Random(c // 3)
        n = r.randint(1, 6)
        out += [(c, i, ("user", "assistant")[i % 2], base.choice("abc") * 3) for i in range(n)]
    out += [(40, None, None, None), (40, 1, "user", None), (41, -5, "user", "x"), (41, 700, "assistant", "y"), (41, 700, "assistant", "y"), (None, 1, "user", "alone")]
    return out


def frame(spark, data):
    return spark.createDataFrame([(*x, 1, 2) for x in data], SCHEMA).repartition(3)


def test_against_brute_force(spark):
    got = {r["conv_id"]: r["text"] for r in chat.format_chats(frame(spark, rows())).collect()}
    assert got == brute(rows()) and 5 < len(got) < 30


def test_long_conversations_come_in_parts(spark):
    data = [(1, i, "user", str(i)) for i in range(2500)] + [(2, i, "user", str(i)) for i in range(900)]
    got = sorted(chat.format_chats(frame(spark, data)).collect(), key=lambda r: r["part"])
    assert [(r["conv_id"], r["part"], r["n_turns"]) for r in got] == [(1, 0, 2500), (1, 1, 2500), (1, 2, 2500)]
    assert "".join(r["text"] for r in got) == brute(data)[1]


def test_a_third_of_all_turns_has_no_conversation_and_no_order(spark):
    """Rows without conv_id whose turn numbers are null, equal, or few, and one row that is repeated: no group holds them all."""
    data = [(None, None if i % 3 == 0 else i % 2, "user", f"text {i}") for i in range(600)] + [(None, 1, "user", "again")] * 400
    data += [(c, t, "user", f"{c} {t}") for c in range(200) for t in range(10)]
    df = frame(spark, data)
    got = sorted((r for r in chat.format_chats(df).collect() if r["conv_id"] is None), key=lambda r: r["part"])
    assert "".join(r["text"] for r in got) == brute(data)[None] and {r["n_turns"] for r in got} == {1000}
    turns = chat.positions(df)
    assert turns.groupBy("conv_id", "c").count().agg({"count": "max"}).first()[0] <= chat.CHUNK
    assert sorted(r["j"] for r in turns.where("conv_id is null").collect()) == list(range(1, 1001))
    alone = df.where("conv_id is null").groupBy("turn", "role", "text").count().repartitionByRange(4, "turn", "role", "text")
    assert alone.selectExpr("spark_partition_id() AS r").distinct().count() == 4


def test_empty(spark):
    assert chat.format_chats(frame(spark, rows()).limit(0)).count() == 0


def test_native(spark):
    assert "Python" not in chat.format_chats(frame(spark, rows()))._jdf.queryExecution().executedPlan().toString()
