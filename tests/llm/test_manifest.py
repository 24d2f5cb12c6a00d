import hashlib
import zlib

import pytest

from eddyline.llm import manifest as M
from tests.llm.conftest import DOCS


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    i, text, lang, source, n = row[:5]
    values = (i, source, lang, None if n is None else n + more, text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes):
    """(root, per leaf its list of (siblings to the left, to the right)) by pairing level by level."""
    level, owners, paths = hashes, [[k] for k in range(len(hashes))], [[] for _ in hashes]
    while len(level) > 1:
        pairs = [(level[k : k + 2], owners[k : k + 2]) for k in range(0, len(level), 2)]
        for nodes, below in pairs:
            for k, leaves in enumerate(below):
                for x in leaves:
                    paths[x].append(("".join(nodes[:k]), "".join(nodes[k + 1 :])))
        level, owners = [digest(*nodes) for nodes, _ in pairs], [sum(below, []) for _, below in pairs]
    return level[0], paths


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        ranked = sorted(trees[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built[lang] = (ranked, *tree([leaf(r) for r in ranked]))
    root, above = tree([built[x][1] for x in order])
    out = []
    for lang, up in zip(order, above, strict=True):
        ranked, subroot, paths = built[lang]
        for r, path in zip(ranked, paths, strict=True):
            path = path + up
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            x = leaf(r, 1 if hit else 0)
            for left, right in path:
                x = digest(left, x, right)
            out.append((r[0], leaf(r), subroot, root, digest(*(a + b for a, b in path)), x, x == root))
    return sorted(out, key=repr)


def got(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_matches_pairing_level_by_level(docs, rows):
    out = got(M.query(docs))
    assert out == brute(rows)
    assert 0 < sum(not r[-1] for r in out) < len(out)


@pytest.mark.parametrize("digits", [1, 3])
def test_rounds_of_small_blocks(spark, rows, monkeypatch, digits):
    """Few digits a round: many rounds, blocks that are not full, trees of different heights."""
    monkeypatch.setattr(M, "DIGITS", digits)
    few = rows[:21] if digits == 1 else rows
    assert got(M.query(spark.createDataFrame(few, DOCS).repartition(3))) == brute(few)


def test_nulls_ties_lone_leaf_and_clashes(spark, empty, clashing, rows):
    odd = [(None, None, None, None, None), (None, None, None, None, None), (7, "", None, "s", None), (7, "", None, "s", None), (8, "é" * 10, "fr", None, 3)]
    assert got(M.query(spark.createDataFrame(odd, DOCS))) == brute(odd)
    one = [(5, "alone", "en", "s", 5)]
    out = got(M.query(spark.createDataFrame(one, DOCS)))
    assert out == brute(one) and out[0][1] == out[0][2] == out[0][3] and out[0][4] == digest()
    assert M.query(empty).collect() == []
    assert M.query(clashing).count() == len(rows)


def test_manifest_finds_every_changed_field(spark):
    """A changed field of any kind leads to another root than the manifest's."""
    from pyspark.sql import functions as F

    rows = [(k, f"text {k}", "en" if k % 3 else "de", "s", k) for k in range(20)]
    df = spark.createDataFrame(rows, DOCS)
    proofs = {r["doc_id"]: r for r in M.manifest(df).collect()}
    for name, value in (("text", F.lit("other")), ("source", F.lit(None).cast("string")), ("n_chars", F.lit(99))):
        changed = df.withColumn(name, value).select("doc_id", M.leaf([F.col(c) for c in M.FIELDS]).alias("now"))
        known = spark.createDataFrame([(i, r["path"], r["root"]) for i, r in proofs.items()], f"doc_id long, path {M.PATH}, root string")
        back = changed.join(known, "doc_id").select((M.folded(F.col("now"), F.col("path")) == F.col("root")).alias("ok"))
        assert not any(r["ok"] for r in back.collect())
