import time
import zlib

import numpy as np
import pytest

from eddyline.llm import byte_cnn as B
from eddyline.llm import html_crf as H
from eddyline.llm.labelled_pages import labelled_pages
from tests.conftest import SF_SMALL


def test_chunks_cover_every_window():
    for n in (0, 1, 7, 8, 511, 512, 513, 1016, 1017, 5000):
        text = bytes(np.random.default_rng(n).integers(1, 256, n, dtype=np.uint8))
        have = {c[i : i + B.WIDTH].tobytes() for c in B.chunks_of(text) for i in range(B.CHUNK - B.WIDTH + 1)}
        assert {text[i : i + B.WIDTH] for i in range(n - B.WIDTH + 1)} <= have


def test_gradients_train_a_separable_task():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.choice(list(b"abcdef ") if k % 2 else list(b"abcdef#"), 300).astype(np.uint8)) for k in range(120)]
    labels = np.arange(120) % 2
    net = B.train([B.chunks_of(t) for t in texts[:80]], labels[:80])
    assert ((net.scores(texts[80:]) >= 0.5) == labels[80:]).all()


def test_scores_match_a_plain_convolution():
    """Every window of every chunk, one after the other, in Python."""
    net = B.Network(np.random.default_rng(3))
    net.bias[:] = 0.1
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 8, 60, 511, 513, 1300):
        text = bytes(rng.integers(1, 256, n, dtype=np.uint8))
        pooled, fills = [], []
        for start in range(0, max(n - B.WIDTH + 1, 1) if n <= B.CHUNK else n, B.STEP):
            chunk = text[start : start + B.CHUNK]
            if start and start + B.CHUNK - B.STEP >= n:
                break
            best = np.zeros(B.FILTERS)
            for i in range(min(len(chunk), B.WINDOWS)):
                window = chunk[i : i + B.WIDTH]
                x = np.concatenate([net.embedding[b] for b in window] + [np.zeros(B.DIM)] * (B.WIDTH - len(window)))
                best = np.maximum(best, x @ net.filters + net.bias)
            if len(chunk):
                pooled.append(best)
                fills.append(np.log2(1 + len(chunk)) / np.log2(1 + B.CHUNK))
        x = np.concatenate([np.mean(pooled, axis=0), np.max(pooled, axis=0), [np.mean(fills)]]) if pooled else np.zeros(2 * B.FILTERS + 1)
        hidden = np.tanh(x @ net.hidden + net.hidden_bias)
        assert abs(net.scores([text])[0] - 1 / (1 + np.exp(-(hidden @ net.out + net.out_bias[0])))) < 1e-4, n


def test_contradicting_labels_and_repeated_ids(spark):
    rows = [(k, f"text number {k}") for k in range(30)] + [(4, "another text")]
    labels = [(k, k % 2, 0) for k in range(30)] + [(0, 1, 0), (3, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    parts, y = B.training_chunks(df, lab)
    want = [k for k in range(1, 30) if zlib.crc32(str(k).encode()) % 3 != 1]
    assert y.tolist() == [k % 2 for k in want]
    again, _ = B.training_chunks(df.orderBy(df.doc_id.desc()).repartition(3), lab)
    assert all((a == b).all() for a, b in zip(parts, again, strict=True))


def test_scores_are_per_row_and_batch_free(spark, docs, rows, empty, clashing):
    net = B.Network(np.random.default_rng(5))
    out = B.score(docs, net)
    for r in out.collect():
        assert abs(r["score"] - net.scores([(r["text"] or "").encode()])[0]) < 1e-5 and 0 <= r["score"] <= 1
        assert r["predicted"] == (r["score"] >= 0.5)
    assert B.score(empty, net).collect() == []
    clash = B.score(clashing, net)
    assert clash.count() == len(rows) and [c.lower() for c in clash.columns].count("score") == 1


def test_held_out_accuracy_on_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    out = B.query(docs, labels).join(labels, "doc_id").collect()
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    held = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.85


def test_training_never_sees_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    held = {r[0] for r in labels.select("doc_id").collect() if zlib.crc32(str(r[0]).encode()) % 3 == 1}
    parts, y = B.training_chunks(docs, labels)
    keep = labels.where(~labels.doc_id.isin(list(held)))
    again, z = B.training_chunks(docs, keep)
    assert len(parts) == len(again) and (y == z).all() and all((a == b).all() for a, b in zip(parts, again, strict=True))
    none, y = B.training_chunks(docs, labels.limit(0))
    assert none == [] and len(y) == 0


# ---------------------------------------------------------------- pages


def model():
    if not hasattr(model, "held"):
        model.held = H.train(H.training_set())
    return model.held


def test_held_out_pages():
    wrong = total = 0
    for rows, labels in H.training_set(labelled_pages(150, seed=77)):
        got = model().decode(rows)
        wrong += sum(a != b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert wrong / total < 0.03


def test_viterbi_finds_the_best_of_all_labellings():
    import itertools

    m = H.Model()
    rng = np.random.default_rng(2)
    for w in (m.emit, m.step, m.start, m.end):
        w[...] = rng.normal(size=w.shape)
    rows = [list(rng.choice(len(H.NAMES), 5, replace=False)) for _ in range(7)]

    def worth(y):
        e = sum(m.emit[on, k].sum() for on, k in zip(rows, y, strict=True))
        return e + sum(m.step[a, b] for a, b in zip(y, y[1:], strict=False)) + m.start[y[0]] + m.end[y[-1]]

    assert tuple(m.decode(rows)) == max(itertools.product((0, 1), repeat=7), key=worth)
    assert m.decode([]) == []


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/a'>Home</a></li></ul></nav>"
    '<!-- <p>no</p> --><div class="cookie-notice"><p>We use cookies. Accept them.</p></div><article><h1>A &amp; B</h1>'
    "<p><b>First   line\nof text, with &eacute;.<br>More of it.<p>Second <i>para</i>graph, which is long enough to look like prose.</p>"
    '<div class="ad">Buy now!</div><p>Third paragraph closes the article with some more words.</p></article>'
    '<section id="comments"><p>I liked this article a lot, thank you.</p></section><footer>&copy; 2020 Someone</footer>'
    "<script>var a = '<p>x</p>';</script></body></html>"
)


def test_a_page():
    assert H.main_text(PAGE, model()) == (
        "A & B\n\nFirst line of text, with é. More of it.\n\nSecond paragraph, which is long enough to look like prose."
        "\n\nThird paragraph closes the article with some more words."
    )


def test_pages_of_the_tables(spark):
    out = H.query(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    hits = seen = 0
    for r in out:
        assert r["n_chars"] == len(r["text"])
        name = r["url"].split("?")[0].split("#")[0].rstrip("/").rsplit("/", 1)[-1]
        if name.isdigit() and int(name) in docs:
            lines = [" ".join(x.split()) for x in docs[int(name)].split("\n") if x.strip()]
            seen += 1
            hits += r["text"].split("\n\n")[1:] == lines
    assert seen > 20 and hits / seen > 0.95


def test_broken_and_empty_pages(spark):
    pages = ["", None, "plain words only", "<p>unclosed", "<!-- open", "<script>x", "<a href='<p>x", "<<<>>><p", "&amp;&#x41;&nosuch;", "<p " * 2000,
             "<div>" * 3000 + "deep", "<a \"" * 3000]
    df = spark.createDataFrame([(k, "u", p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    out = {r["page_id"]: r for r in H.query(df).collect()}
    assert len(out) == len(pages) and out[0]["text"] == out[1]["text"] == "" and out[1]["n_chars"] == 0
    assert H.query(df.limit(0)).collect() == []


def test_open_head_ends_at_content():
    head = "<html><head><title>x</title><meta charset=utf-8>\n"
    for body in ("<p>Article text", "Article text", "<span>Article text</span>", "<head><p>Article text", "<div><p>Article text</div>", "<body><p>Article text"):
        assert [b.text for b in H.blocks(head + body)] == ["Article text"], body
        assert "head" not in H.blocks(head + body)[0].tags


@pytest.mark.parametrize("unit", ["<div>x", "<span>x", "<h1>x", "<p><div><h1>x", "<i></article>x", "<b><div><span>x</b>", "<li>x", "<p><span><section>x"])
def test_unclosed_tags_stay_linear(unit):
    """Time of 100,000 broken elements with text at each level, against a quarter of them."""
    def spent(n):
        page = unit * n
        start = time.process_time()
        found = H.features(H.blocks(page))
        return time.process_time() - start, found

    few, _ = spent(25_000)
    many, found = spent(100_000)
    assert found and many < 12 * few + 1
