import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eddyline.llm import feistel_shards as S
from eddyline.llm import poisson_mix as P


@pytest.mark.parametrize("n", [1, 2, 3, 7, 24, 25, 26, 1000, 1023, 1025])
def test_permutation_is_one_to_one(spark, n):
    out = [r[0] for r in spark.range(n).select(S.permuted(F.col("id"), n)).collect()]
    assert sorted(out) == list(range(n))
    assert n < 20 or out != sorted(out)


def test_permutation_of_large_ranges(spark):
    n = 10**12 + 39
    ids = spark.range(n - 5000, n).union(spark.range(5000))
    out = [r[0] for r in ids.select(S.permuted(F.col("id"), n)).collect()]
    assert len(set(out)) == 10000 and all(0 <= x < n for x in out)


def test_query_holds_its_law(docs, rows):
    out = S.query(docs).collect()
    assert sorted(r["row_number"] for r in out) == list(range(len(rows)))
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert set(by) == set(range(24)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    assert {r["law"] for r in out} == {"rows"} and {r["grown_shard"] for r in out} == {None}


def test_shards_do_not_depend_on_the_layout(docs, rows, clashing):
    one = sorted(map(tuple, S.query(docs.repartition(1)).collect()), key=repr)
    assert one == sorted(map(tuple, S.query(docs.repartition(7)).collect()), key=repr)
    assert len(S.query(clashing).collect()) == len(rows)


def test_locate(spark, docs):
    out = S.query(docs)
    n = out.count()
    shard, slot = S.locate(F.col("row_number"), n, 24)
    assert out.where((shard != F.col("shard")) | (slot != F.col("slot"))).count() == 0


def test_many_copies_unfold(spark, empty):
    df = spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    out = S.query(df).collect()
    assert sorted(r["row_number"] for r in out) == list(range(10_000))
    assert S.query(empty).collect() == []


# ---------------------------------------------------------------- mixing


def test_counts_invert_the_poisson_distribution(spark):
    for mean in (0.05, 1.0, 7.5, 31.9):
        table = spark.range(1).select(P.cumulative(F.lit(mean))).first()[0]
        total = 0.0
        for k, c in enumerate(table):
            total += math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1))
            assert abs(c - total) < 1e-12
        assert total > 1 - 1e-12


def test_rates_reach_the_targets(spark):
    df = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"),
        F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 100 == 1, "rare").otherwise("other").alias("source"),
    )
    out = P.replicate(df, {"big": 1, "rare": 2, "other": 1}, shuffle=False)
    counts = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    for name, share in (("big", 0.25), ("rare", 0.5), ("other", 0.25)):
        assert abs(counts[name] - share * 60_000) < 6 * math.sqrt(60_000 * share) * 6
    rare = [r for r in out.where("source = 'rare'").groupBy("doc_id", "copies", "rate").count().collect()]
    assert all(r["copies"] == r["count"] and r["rate"] > P.MAX_MEAN for r in rare)
    mean = sum(r["copies"] for r in rare) / len(rare)
    spread = sum((r["copies"] - mean) ** 2 for r in rare) / len(rare)
    assert 0.7 < spread / mean < 1.4  # a Poisson count varies as much as its mean


def test_draws_depend_on_the_document_only(docs, empty, clashing):
    a = sorted(map(repr, P.query(docs.repartition(1)).collect()))
    assert a == sorted(map(repr, P.query(docs.repartition(6)).collect()))
    assert P.query(empty).collect() == []
    out = P.query(clashing)
    assert len(out.columns) == len({c.lower() for c in out.columns}) and out.count() == len(a)


def test_without_broadcast(docs, monkeypatch):
    a = sorted(map(repr, P.query(docs).collect()))
    monkeypatch.setattr(P, "BROADCAST_SOURCES", 0)
    assert sorted(map(repr, P.query(docs).collect())) == a


def test_global_order(docs):
    keys = [r["shuffle_key"] for r in P.query(docs).collect()]
    assert keys == sorted(keys) and len(keys) > 50


def test_no_python_in_the_plans(docs):
    for df in (S.query(docs), P.query(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
