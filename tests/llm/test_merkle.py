import hashlib

from eddyline.llm import merkle as M


def pairs(rows):
    """Rows in order (null ids first, ties by any order) with their successors."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return list(zip(order, [*order[1:], order[0]], strict=True))


def edited(a, b):
    a, b = a or "", b or ""
    k = len(a) // 2
    return a[: len(a) - k] + b[:k]


def test_each_document_meets_the_next(spark, rows):
    unique = list({r[0]: r for r in rows if r[0] is not None}.values()) + [(None, "a null id", "en", "s", 0)]
    df = spark.createDataFrame([r[:2] for r in unique], "doc_id long, text string").repartition(6)
    out = {r["doc_id"]: r for r in M.query(df).collect()}
    assert len(out) == len(unique)
    for a, b in pairs(unique):
        r = out[a[0]]
        assert r["n_chars"] == len(a[1] or "")
        assert r["edited_sha256"] == hashlib.sha256(edited(a[1], b[1]).encode()).hexdigest()
        assert r["fingerprint"] == M.fingerprint((a[1] or "").encode())
        assert r["edited_fingerprint"] == M.fingerprint(edited(a[1], b[1]).encode())
        assert r["near_next"] == M.likeness(r["fingerprint"], M.fingerprint((b[1] or "").encode()))
        assert r["near_edited"] == M.likeness(r["fingerprint"], r["edited_fingerprint"])


def test_repeated_ids_and_edge_cases(spark, docs, rows, empty, clashing):
    assert M.query(docs).count() == len(rows)
    assert M.query(empty).collect() == []
    one = spark.createDataFrame([(5, "only one text")], "doc_id long, text string")
    r = M.query(one).first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(edited("only one text", "only one text").encode()).hexdigest()
    out = M.fingerprints(clashing)
    assert out.count() == len(rows) and [c.lower() for c in out.columns].count("fingerprint") == 1


def test_roots_test_equality(rows):
    texts = {r[1] or "" for r in rows} | {"a\nb", "a\n\nb", "b\na", "a\nb\n", "a b", "ab"}
    prints = {M.fingerprint(t.encode()) for t in texts}
    assert len(prints) == len(texts) == len({p.split("/")[0] for p in prints})


def test_likeness_and_edits():
    lines = [f"paragraph number {k} with some words of its own {k * k}" for k in range(40)]
    a = "\n".join(lines)
    b = "\n".join([*lines[:10], "a line that was put in", *lines[10:20], lines[20].replace("some", "other"), *lines[21:]])
    fa, fb = M.fingerprint(a.encode()), M.fingerprint(b.encode())
    assert 0.9 < M.likeness(fa, fb) < 1 and M.likeness(fa, fb) == M.likeness(fb, fa)
    left, right = M.edits(fa, fb)
    assert "".join(a[i:j] for i, j in left).count("some") == 1
    changed = "".join(b[i:j] for i, j in right)
    assert "a line that was put in" in changed and "other" in changed and len(changed) < 120
    assert M.likeness(fa, M.fingerprint(b"nothing in common")) == 0
    # the parts of a moved section are still found
    assert M.likeness(fa, M.fingerprint("\n".join(lines[20:] + lines[:20]).encode())) > 0.9
