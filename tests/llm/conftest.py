import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def edit(rng, text, share):
    out = text.split(" ")
    for k in range(len(out)):
        if rng.random() < share:
            out[k] = words(rng, 1)
    return " ".join(out)


def corpus() -> list[tuple]:
    """Rows with copies, near copies of one text, shared lines, null and empty texts, a null
    id, a repeated row, one very long text and texts that differ in case and spacing only."""
    rng = random.Random(7)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(40)]
    base = words(rng, 90)
    texts += [base] * 12 + [edit(rng, base, 0.03) for _ in range(40)]
    texts += [f"{words(rng, 30)}\n  Shared LINE of all\t\n{words(rng, 30)}" for _ in range(11)]
    texts += [f"{words(rng, 30)}\nRare line\n{words(rng, 5)}" for _ in range(9)]
    texts += [None, "", "\n\n", "   ", "one", "ONE", "one  two", base.upper(), base.replace(" ", "\n"), "é ü 漢字 😀"]
    texts += [words(rng, 60_000)]
    rows = [(k * 3 + 1, t, ["en", "fr", None][k % 3], f"src{k % 4}" if k % 7 else None, len(t or "")) for k, t in enumerate(texts)]
    return [*rows, rows[5], (None, words(rng, 50), "en", "src0", 0), (None, base, "en", "src0", 0)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(spark, rows):
    """The same rows with columns named like results (in other case too)."""
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    names = ("N_WORDS", "n_lines", "score", "Shard", "copies", "rate", "fingerprint", "kept", "component_id", "sequence_id")
    return df.withColumns({n: F.lit("x") for n in names})
