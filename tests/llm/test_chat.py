from eddyline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def turns(conv, *texts):
    return [(conv, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(texts)]


def render(*texts):
    return "".join(f"<|im_start|>{'user' if k % 2 == 0 else 'assistant'}\n{t}<|im_end|>\n" for k, t in enumerate(texts))


def test_snapshots_collapse_to_the_longest(spark):
    rows = turns(1, "a") + turns(2, "a", "b") + turns(3, "a", "b", "c") + turns(4, "a", "x") + turns(5, "a", "b", "c") + turns(6, "b")
    rows += turns(7, "", "b") + turns(8, "ab") + turns(9, "z" * 50_000, "y")
    out = {r["conv_id"]: (r["n_turns"], r["copies"], r["text"]) for r in chat.query(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert out == {
        3: (3, 2, render("a", "b", "c")), 4: (2, 1, render("a", "x")), 6: (1, 1, render("b")), 7: (2, 1, render("", "b")),
        8: (1, 1, render("ab")), 9: (2, 1, render("z" * 50_000, "y")),
    }


def test_matches_comparing_all_prefixes(spark):
    import random

    rng = random.Random(5)
    convs = {c: [rng.choice("ab") for _ in range(rng.randint(1, 6))] for c in range(80)}
    rows = [t for c, x in convs.items() for t in turns(c, *x)]
    out = {r["conv_id"]: r["copies"] for r in chat.query(spark.createDataFrame(rows, SCHEMA)).collect()}
    whole = {}
    for c, x in convs.items():
        whole.setdefault(tuple(x), []).append(c)
    want = {min(c): len(c) for x, c in whole.items() if not any(len(y) > len(x) and y[: len(x)] == x for y in whole)}
    assert out == want


def test_a_hot_conversation_is_cut(spark):
    """Two conversations with most of all turns, one a snapshot of the other, among short ones."""
    long = [f"t{k}" for k in range(600)]
    rows = turns(1, *long[:590]) + turns(2, *long) + [t for c in range(10, 60) for t in turns(c, "t0", f"own {c}")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = {r["conv_id"]: (r["n_turns"], r["copies"], r["text"]) for r in chat.query(df).collect()}
    assert out == {2: (600, 1, render(*long))} | {c: (2, 1, render("t0", f"own {c}")) for c in range(10, 60)}
    ranges = chat.assign_buckets(df, ["conv_id"], ["turn"]).df.groupBy("conv_id", "_b").count().where("conv_id = 2")
    assert ranges.count() > 1


def test_nulls_ties_and_empty(spark):
    rows = [(None, 0, "user", "hi"), (None, 0, "user", "hi"), (None, 1, "user", "alone"), (1, 0, None, None), (1, 0, None, "t"), (2, None, "user", "q"),
            (3, 0, "user", "alone")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = sorted(((r["conv_id"], r["n_turns"], r["copies"], r["text"]) for r in chat.query(df).collect()), key=repr)
    one = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert out == sorted([
        (None, 1, 2, one("user", "hi")), (3, 1, 2, one("user", "alone")), (1, 2, 1, one("", "") + one("", "t")), (2, 1, 1, one("user", "q")),
    ], key=repr)
    assert chat.query(df.limit(0)).collect() == []
