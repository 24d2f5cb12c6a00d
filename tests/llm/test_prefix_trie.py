import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eddyline.llm import prefix_trie as M

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def item(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, item(role, text), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members, children = {}, {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in below)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out[min(members[node]), len(node)] = (
            parent, len(members[node]), len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()
        )
    return out


def got(df):
    rows = df.collect()
    out = {(r["conv_id"], r["depth"]): tuple(r[n] for n in NAMES) for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(seed=3):
    """Few distinct texts (much is shared), equal conversations, families of twenty, gaps."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 90), *range(200, 215), *range(401, 460, 3), -7, -20, -21]:
        for k in range(rng.choice([1, 1, 2, 3, 4, 5, 7])):
            rows.append((c, k, rng.choice(["user", "assistant"]), " ".join(rng.choices(["a", "b  c", "d\te"], k=rng.randint(0, 2)))))
    rows += [(c, k, "user", f"common {k}") for c in range(600, 640) for k in range(6)]
    return rows


def test_matches_all_prefixes(spark):
    rows = corpus()
    out = got(M.query(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert out == brute(rows)


@pytest.mark.parametrize("width", [8, 1 << 14])
def test_false_alarms_of_the_sketch_change_nothing(spark, monkeypatch, width):
    """A sketch of eight counters a row screens nothing out; small pieces cut the member lists."""
    monkeypatch.setattr(M, "WIDTH", width)
    monkeypatch.setattr(M, "PIECE", 3)
    rows = corpus(4)
    assert got(M.query(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_hot_conversation_and_hot_prefix(spark):
    """A conversation of a third of all turns, twice, and a first turn that all others share."""
    rng = random.Random(5)
    long = [("user", str(rng.random())) for _ in range(700)]
    rows = [(c, k, role, text) for c in (1000, 1001) for k, (role, text) in enumerate(long)]
    rows += [(c, k, "user", "hello" if k == 0 else str(rng.randint(0, 2))) for c in range(2000, 2200) for k in range(4)]
    assert got(M.query(spark.createDataFrame(rows, SCHEMA).repartition(6))) == brute(rows)


def test_nulls_ties_turnless_and_empty(spark):
    # 21 borrows from a conversation that is not there and loses its only turn
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(lone, 0, "user", "gone"), (None, 0, "user", "no id"), (41, None, None, None), (41, None, "user", "x"), (41, 2, "user", None),
            (41, 2, "user", None), (60, 0, "a", "b"), (61, 0, "ab", ""), (62, 5, "user", "z" * 40_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(M.query(df)) == brute(rows)
    assert M.query(df.limit(0)).collect() == []
    only = [(lone, 0, "user", "gone")]
    out = got(M.query(spark.createDataFrame(only, SCHEMA)))
    assert out == brute(only) == {(lone, 0): (None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())}
    clash = df.withColumns({n: F.lit("x") for n in ("depth", "k1", "words", "AT", "alone")})
    assert got(M.query(clash)) == brute(rows)


def test_estimates_never_count_too_little(spark, monkeypatch):
    monkeypatch.setattr(M, "WIDTH", 64)
    monkeypatch.setattr(M, "SLICES", 4)
    rng = np.random.default_rng(1)
    once = rng.integers(-(1 << 63), 1 << 63, 60, dtype=np.int64)
    twice = rng.integers(-(1 << 63), 1 << 63, 60, dtype=np.int64)
    df = spark.createDataFrame([(int(x),) for x in [*once, *twice, *twice]], "k1 long")
    bits, factors = M.screen(df), M.factors_of(spark)
    assert not M.proven_single(twice, bits, factors).any()
    assert M.proven_single(once, bits, factors).sum() > 20
