import re

from pyspark.sql import functions as F

from eddyline.llm import quality_rules as Q


def expected(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    again = {x for x in windows if windows.count(x) > 1} if len(windows) < 3000 else set()
    covered = {i + k for i, x in enumerate(windows) if x in again for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
    )


REPEATS = "a b c d e f g h\na b c d e f g h\nx a b c d e f g h a | b # é\n\n \n"


def test_measures_match_brute_force(spark, docs, rows):
    more = [REPEATS, "a " * 20, "a b c d e f g h i " * 3, "### $$ <é> " * 30, None, "\x0b\x0c\r\t"]
    texts = [r[1] for r in rows if r[1] is None or len(r[1]) < 100_000] + more
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in Q.query(df).collect():
        e = expected(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == e
        assert r["base_failed"] == (e[0] < 20 or 100 * e[4] > 30 * e[0])
        assert not (r["base_failed"] and r["kept"])


def test_policies_and_ablation_from_stored_bits(spark):
    bits = [0, 1, 2, 3, 4, 4, 256, 5]
    entries = spark.createDataFrame([(b,) for b in bits], "fail_bits long")
    kept = Q.apply_policy(entries, "base").groupBy("kept").count().collect()
    assert {r["kept"]: r["count"] for r in kept} == {True: 4, False: 4}
    table = {(r["policy"], r["rule"]): r for r in Q.ablation(entries).collect()}
    for version, mask in Q.POLICIES.items():
        for rule, bit in Q.BIT.items():
            if mask & bit:
                r = table[version, rule]
                assert r["documents"] == len(bits)
                assert r["rejected"] == sum(b & mask != 0 for b in bits)
                assert r["failed"] == sum(b & bit != 0 for b in bits)
                assert r["only"] == sum(b & mask == bit for b in bits)


def test_an_acronym_does_not_reject_another_script(spark):
    russian = "Международная организация объявила сегодня о новой программе сохранения памятников культуры в разных странах мира и назвала её первых участников"
    rows = [(1, f"{russian} {russian[::-1]}"), (2, russian + " UNESCO " + russian[::-1]), (3, f"{russian} UNESCO {russian[::-1]}".upper()), (4, "SHOUTED WORDS " + " ".join(f"WORD{k}" for k in range(40))),
            (5, " ".join(f"plain word{k}" for k in range(30)))]
    out = {r["doc_id"]: r["kept"] for r in Q.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[2] and out[5] and not out[4] and out[3] == out[1]


def test_edge_cases(empty, clashing, rows):
    assert Q.query(empty).collect() == [] and Q.ablation(Q.ledger(empty)).collect() == []
    out = Q.ledger(clashing)
    assert out.count() == len(rows)
    assert [c.lower() for c in out.columns].count("n_words") == 1 and dict(out.dtypes)["n_words"] == "bigint"
    blank = out.where(F.col("text").isNull()).collect()
    assert [r["n_words"] for r in blank] == [0] and [r["fail_bits"] for r in blank] == [1]
