import random
import zlib

import numpy as np
import pytest

from eddyline.llm import toxicity as M
from tests.llm.conftest import words

BAD = ["vile", "rotten", "nasty", "filthy"]


def labelled(n=260, seed=9):
    """Texts of several sentences; toxic ones have two to four sentences with a bad word."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        said = [words(rng, rng.randint(4, 12)) for _ in range(rng.randint(5, 14))]
        toxic = k % 4 == 0
        if toxic:
            for at in rng.sample(range(len(said)), rng.randint(2, 4)):
                parts = said[at].split(" ")
                parts.insert(rng.randint(0, len(parts)), rng.choice(BAD))
                said[at] = " ".join(parts)
        out.append((k, ". ".join(said) + ".", int(toxic)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = [r for r in labelled() if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    return M.train([r[1] for r in rows], np.array([r[2] for r in rows]))


def test_gradient_is_the_slope_of_the_loss():
    rows = labelled(24)
    bags, labels = M.Bags([r[1] for r in rows]), np.array([r[2] for r in rows])
    rng = np.random.default_rng(0)
    weights = rng.normal(0, 0.3, len(bags.grams))
    loss, g, g_bias = bags.gradient(weights, -2.0, labels)
    for k in rng.integers(0, len(weights), 12):
        moved = weights.copy()
        moved[k] += 1e-5
        assert abs((bags.gradient(moved, -2.0, labels)[0] - loss) / 1e-5 - g[k]) < 1e-4
    assert abs((bags.gradient(weights, -2.0 + 1e-5, labels)[0] - loss) / 1e-5 - g_bias) < 1e-4
    # the loss is the noisy-or's, computed plainly
    model = M.Model({x: float(w) for x, w in zip(bags.grams, weights, strict=True)}, -2.0)
    p = np.array([model.score(r[1]) for r in rows])
    assert abs(-np.where(labels == 1, np.log(p), np.log(1 - p)).mean() - loss) < 1e-9


def test_held_out_rows_and_offending_sentences(spark, model):
    rows = [r for r in labelled() if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    right = [(model.score(text) >= M.THRESHOLD) == bool(toxic) for _, text, toxic in rows]
    assert len(right) > 40 and np.mean(right) > 0.95
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = M.offending(df, model).collect()
    text = {r[0]: r[1] for r in rows}
    assert all(text[r["doc_id"]][r["start"] : r["end"]] == r["sentence"] for r in found)
    with_bad = [any(b in r["sentence"] for b in BAD) for r in found]
    said = sum(any(b in s for b in BAD) for r in rows for s in r[1].split("."))
    assert np.mean(with_bad) > 0.9 and sum(with_bad) > 0.8 * said


def test_score_is_the_noisy_or_of_all_sentences(spark, model, docs, rows):
    def plain(text):
        keep = 1.0
        for _, _, found in M.sentences(text or ""):
            z = model.bias + sum(sum(model.weights.get(g, 0) for g in set(M.grams(w))) for w in set(found))
            keep *= 1 - 1 / (1 + np.exp(-z))
        return 1 - keep

    out = M.score(docs, model).collect()
    assert len(out) == len(rows) and [c for c in out[0].asDict()][:5] == docs.columns
    assert all(abs(r["score"] - plain(r["text"])) < 1e-9 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert {r["score"] for r in out if not (r["text"] or "").strip()} == {0.0}


def test_sentences_cover_all_words():
    text = "One two! Three?\n\nfour 5... " + " ".join(f"w{k}" for k in range(150)) + "\nend"
    cut = list(M.sentences(text))
    assert [w for _, _, s in cut for w in s] == M.WORD.findall(text.lower())
    assert max(len(s) for _, _, s in cut) == M.LONGEST
    assert all(M.WORD.findall(text[a:b].lower()) == s for a, b, s in cut)


def test_query(spark, empty, clashing):
    rows = labelled() + [(900, None, 0), (901, "", 0), (902, "vile. rotten. nasty", 0)]
    df = spark.createDataFrame([r[:2] for r in rows] + [(None, "no id"), (4, "a second text")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows[:-1]] + [(902, 1, 0), (902, 1, 1), (None, 0, 1), (77, 0, None)], "doc_id long, quality int, toxic int")
    out = M.query(df, labels).collect()
    assert len(out) == len(rows) + 2
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    truth = {r[0]: r[2] for r in rows[:-3]}
    seen = [r for r in out if r["doc_id"] in truth and r["doc_id"] != 4]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in seen]) > 0.95
    assert M.query(empty, labels).collect() == []
    assert M.query(df, labels.limit(0)).count() == len(out)
    assert M.query(clashing, labels).columns == ["doc_id", "held_out", "score", "predicted"]


def test_labels_held_out_or_contradicting_are_not_used(spark):
    rows = [(k, f"text {k}", k % 2) for k in range(40)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(0, 1), (3, 0)], "doc_id long, toxic int")
    texts, y = M.training_texts(df, labels)
    want = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2 and r[0] not in (0, 3)]
    assert (texts, y.tolist()) == ([r[1] for r in want], [r[2] for r in want])
