import random

import pytest

from eddyline.llm import minhash_forest as M
from eddyline.llm.components import components
from tests.llm.conftest import edit, words


def shingle_set(text):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(doc_id, set size, component) per row by comparing all pairs."""
    sets = [shingle_set(r[1]) for r in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                c = len(a & b)
                if 100 * c >= 75 * (len(a) + len(b) - c):
                    group[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=repr)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def test_components_match_all_pairs(docs, rows):
    out = M.near_duplicates(docs)
    assert got(out) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in M.query(docs).collect())


def test_large_regions_keep_their_links(spark, monkeypatch):
    """One text with many near copies of it (a star: copies are mostly not alike), partly at the
    threshold; small limits force deepening, hubs, several blocks, salted hubs and cut regions."""
    for name, value in (("REGION", 4), ("BLOCK", 16), ("SPLIT", 5)):
        monkeypatch.setattr(M, name, value)
    rng = random.Random(3)
    base = words(rng, 150)
    texts = [base] + [edit(rng, base, rng.choice([0.01, 0.02, 0.025])) for _ in range(120)] + [words(rng, 100) for _ in range(30)]
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(M.near_duplicates(df)) == brute(rows)


def test_template_family_keeps_every_link(spark, monkeypatch):
    """Documents that share a long template and are just below the threshold to each other, with
    sixty linked pairs among them: hubs do not join those, and a small limit leaves few neighbours."""
    for name, value in (("REGION", 2), ("SALT", 8)):
        monkeypatch.setattr(M, name, value)
    rng = random.Random(11)
    template = words(rng, 166)
    texts = []
    for _ in range(60):
        own = [words(rng, 1) for _ in range(36)]
        texts.append(f"{template} {' '.join(own)}")
        texts.append(f"{template} {' '.join(own[:8])} {words(rng, 28)}")
    rng.shuffle(texts)
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert len({c for _, _, c in want}) == 60
    assert got(M.near_duplicates(df)) == want


def asked(spark, monkeypatch, texts):
    """(components, pairs asked for in each round) of a table of texts."""
    counts, confirm = [], M.confirmed

    def counting(pairs, sets):
        counts.append(pairs.count())
        return confirm(pairs, sets)

    monkeypatch.setattr(M, "confirmed", counting)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    out = got(M.near_duplicates(df))
    monkeypatch.setattr(M, "confirmed", confirm)
    return out, counts


def near_family(n):
    rng = random.Random(21)
    base = words(rng, 60)
    return [edit(rng, base, rng.choice([0.02, 0.035, 0.05])) for _ in range(n)]


def passage_family(n):
    """One passage in a part of the copies of eight texts: it is rarer than the texts' own words."""
    rng = random.Random(22)
    passage, bodies = words(rng, 80), [words(rng, 100) for _ in range(8)]
    out = []
    for k in range(n):
        body = edit(rng, bodies[k % 8], 0.005)
        out.append(f"{body} {edit(rng, passage, 0.002)}" if k // 8 % 9 == 0 else body)
    return out


@pytest.mark.parametrize("family", [near_family, passage_family])
def test_pairs_asked_for_grow_with_the_documents(spark, monkeypatch, family):
    monkeypatch.setattr(M, "REGION", 8)
    small, few = asked(spark, monkeypatch, family(200))
    large, many = asked(spark, monkeypatch, family(400))
    assert small == brute(list(enumerate(family(200)))) and large == brute(list(enumerate(family(400))))
    assert many[0] <= 3 * few[0] and sum(many[1:]) <= 3 * sum(few[1:]) + 400


@pytest.mark.parametrize("width", [1, 2, 7])
def test_cut_regions_do_not_depend_on_the_partitions(spark, width):
    """A region that a border cuts is dense or small as a whole, however many partitions there are."""
    from pyspark.sql import functions as F

    rng = random.Random(23)
    base, other = words(rng, 120), words(rng, 120)
    texts = [edit(rng, base, 0.02) for _ in range(22)] + [edit(rng, other, 0.02) for _ in range(12)] + [words(rng, 60) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    slim = M.profile(df.withColumn("text_hash", F.xxhash64("text")), "text", ["doc_id", "text_hash"])
    classes = slim.select("set_hash", "signature").dropDuplicates(["set_hash"])
    found = M.materialize(M.forest(classes, width))
    cut, rows = M.cut_regions(found)
    dense = found.where(F.col("kind") == M.DENSE).select("tree", "label", "a").union(rows).distinct()
    prefix = lambda v: tuple(v)
    regions = {}
    for r in classes.collect():
        values = bytes(r["signature"]) + bytes(r["signature"])[: 4 * M.DEPTH]
        for t in range(M.TREES):
            regions.setdefault((t, prefix(values[12 * t : 12 * t + 12])), set()).add(r["set_hash"])
    want = {(t, x) for (t, _), members in regions.items() if len(members) > M.REGION + 1 for x in members}
    assert {(r["tree"], r["a"]) for r in dense.collect()} == want
    proposed = {frozenset((r["a"], r["b"])) for r in found.where("kind = 0").select("a", "b").union(cut).collect()}
    small = {frozenset((x, y)) for m in regions.values() if len(m) <= M.REGION + 1 for x in m for y in m if x != y}
    assert small <= proposed


def test_bitmap_bound_is_never_too_small(spark):
    """Of random sets of all similarities, those similar enough always have room."""
    import numpy as np

    rng = np.random.default_rng(4)
    rows = []
    for k in range(300):
        common = rng.integers(0, 1 << 63, rng.integers(1, 400))
        mine, theirs = (rng.integers(0, 1 << 63, rng.integers(0, 1 + len(common) // 2)) for _ in range(2))
        x, y = np.unique(np.append(common, mine)), np.unique(np.append(common, theirs))
        rows.append((len(x), len(y), M.bitmap(x).tolist(), M.bitmap(y).tolist(), bool(100 * len(common) >= 75 * len(np.union1d(x, y)))))
    df = spark.createDataFrame(rows, "n long, m long, x array<long>, y array<long>, alike boolean")
    out = df.selectExpr("alike", f"{M.room('n', 'm', 'x', 'y')} as room").collect()
    assert all(r["room"] for r in out if r["alike"]) and sum(r["alike"] for r in out) > 50
    assert sum(not r["room"] for r in out) > 50


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_by_a_hot_key(spark, how):
    """Hot keys are broadcast, the others joined; null keys match nothing."""
    from collections import Counter

    from eddyline.llm.common import attach

    keys = [1] * 500 + [2] * 300 + list(range(3, 60)) + [None] * 40
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long").repartition(5)
    sizes = Counter(k for k in keys if k is not None and k < 50)
    table = spark.createDataFrame([(k, f"v{k}", n) for k, n in sizes.items()], "k long, v string, n long")
    out = attach(rows, table, ["k"], "n", how)
    want = [(k, i, f"v{k}" if k in sizes else None) for i, k in enumerate(keys) if how == "left" or k in sizes]
    assert sorted(map(tuple, out.select("k", "i", "v").collect()), key=repr) == sorted(want, key=repr)


def test_representatives(docs, rows, empty, clashing):
    kept = M.keep_representatives(docs)
    assert kept.columns == docs.columns
    named = [r for r in kept.collect() if r["doc_id"] is not None]
    expected = {c for i, _, c in brute(rows) if i is not None}
    assert sorted(r["doc_id"] for r in named) == sorted(expected)
    assert M.keep_representatives(empty).collect() == [] and M.query(empty).collect() == []
    assert M.keep_representatives(clashing).columns == clashing.columns


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 30)], [(9, 3), (3, 5), (8, 2), (2, 9), (None, 4), (20, 21)],
])
def test_components(spark, links):
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {}
    for a, b in links:
        if a is not None and a != b:
            x, y = want.get(a, a), want.get(b, b)
            want |= {a: x, b: y}
            want = {k: min(x, y) if v in (x, y) else v for k, v in want.items()}
    assert out == want
