"""Mixing sources to target weights by Poisson replication.

A source of ``size`` (documents, or the sum of a weight column) that is to make up a share w
of an output of ``total`` is repeated w * total / size times on average. Each document draws
how often it occurs from a Poisson distribution with that mean, by inverting the
distribution at a uniform number hashed from (seed, document), so a draw depends on nothing
but the document and can be repeated anywhere. Documents are unfolded by their counts and
put in a global random order (a range-partitioned sort on a hash of document and copy).

The inversion is a table lookup: per source the cumulative distribution is computed once (one
array of a few dozen values, from the sum of log-probabilities, so no mean underflows) and a
document counts the entries at or below its uniform number. Means above ``MAX_MEAN`` are drawn
as the sum of several Poisson parts, each with its own hash.

Only DataFrame expressions are used. The table of sources is broadcast up to
``BROADCAST_SOURCES`` rows and joined with a shuffle beyond; it is never collected. Defined cases: a null source is a source of its own,
named null in ``weights`` by None; a source without a weight takes ``default_weight``; weights
are relative; a null id or text hashes as null; repeated rows draw the same count each (rows
that are equal cannot be told apart); columns called like a result column are replaced; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.session import materialize

MAX_MEAN = 32.0
SEED = 20240607
TAIL = 1e-18  # what the tabulated tail leaves out; uniform numbers have 52 bits
BROADCAST_SOURCES = 10_000
DIGITS = 13  # hex digits of a uniform number


def uniform(*parts: Column) -> Column:
    """Number in (0, 1) from the md5 of the parts (52 bits)."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("~")) for p in parts))
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("double")
    return (digits + F.lit(0.5)) / F.lit(float(16**DIGITS))


def cumulative(mean: Column) -> Column:
    """Array of P(count <= k), k = 0, 1, ... up to a tail below TAIL, for a mean up to MAX_MEAN."""
    last = F.ceil(mean + 10 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(
        (-mean).alias("log_p"), F.exp(-mean).alias("total"), F.array(F.exp(-mean)).alias("all")
    )  # k = 0

    def step(state: Column, k: Column) -> Column:
        log_p = state["log_p"] + F.log(mean) - F.log(k.cast("double"))
        total = state["total"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), total.alias("total"), F.concat(state["all"], F.array(total)).alias("all"))

    table = F.aggregate(F.sequence(F.lit(1), last), start, step)["all"]
    return F.when(mean > 0, table).otherwise(F.array(F.lit(1.0)))


def repetition_rates(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None,
    source: str = "source",
    size: Column | None = None,
    default_weight: float = 1.0,
    scale: float = 1.0,
) -> DataFrame:
    """(source, documents, size, rate): one row per source."""
    amount = F.count(F.lit(1)) if size is None else F.sum(F.coalesce(size, F.lit(0)))
    per = docs.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("documents"), amount.cast("double").alias("size")
    )
    weight = F.lit(float(default_weight))
    for name, w in (weights or {}).items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    per = materialize(per.withColumn("weight", weight))
    all_size, all_weight = per.agg(F.sum("size"), F.sum("weight")).first()  # two numbers
    rate = F.col("weight") / F.lit(all_weight or 1.0) * F.lit(float(scale) * (all_size or 0.0)) / F.col("size")
    return per.select("source", "documents", "size", F.when(F.col("size") > 0, rate).otherwise(0.0).alias("rate"))


def replicate(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    source: str = "source",
    doc_id: str = "doc_id",
    size: Column | None = None,
    default_weight: float = 1.0,
    scale: float = 1.0,
    seed: int = SEED,
    shuffle: bool = True,
) -> DataFrame:
    """``docs`` unfolded to its copies, plus ``rate``, ``copies`` (of the document), ``copy``
    (0-based) and ``shuffle_key``, sorted by the latter when ``shuffle``."""
    rates = repetition_rates(docs, weights, source, size, default_weight, scale)
    parts = F.greatest(F.ceil(F.col("rate") / MAX_MEAN), F.lit(1))
    rates = rates.select(
        F.col("source").alias("_source"), "rate", parts.alias("_parts"), cumulative(F.col("rate") / parts).alias("_table")
    )
    new = ("rate", "copies", "copy", "shuffle_key")
    kept = [c for c in docs.columns if c.lower() not in new]
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)  # at most BROADCAST_SOURCES rows of about 1 KB
    joined = docs.select(*kept).join(rates, F.col(source).eqNullSafe(F.col("_source")))

    def drawn(part: Column) -> Column:
        # the uniform number rides in the state, so it is hashed once
        start = F.struct(uniform(F.lit(seed), F.col(doc_id), part).alias("u"), F.lit(0).alias("n"))
        step = lambda s, c: F.struct(s["u"].alias("u"), (s["n"] + (c <= s["u"]).cast("int")).alias("n"))
        return F.aggregate("_table", start, step)["n"]

    total = F.aggregate(F.sequence(F.lit(1), F.col("_parts")), F.lit(0), lambda s, k: s + drawn(k))
    copies = F.when(F.col("_parts") == 1, drawn(F.lit(1))).otherwise(total)
    counted = joined.withColumn("copies", copies).where("copies > 0")
    unfolded = counted.select(*kept, "rate", "copies", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.coalesce(F.col(doc_id).cast("string"), F.lit("~")), "copy").cast("binary"))
    unfolded = unfolded.withColumn("shuffle_key", key)
    return unfolded.orderBy("shuffle_key") if shuffle else unfolded


# Target shares of the corpus tables' sources: every source the same share by default, the
# large crawl (src0, a third of all rows) twice that.
WEIGHTS: dict[str | None, float] = {"src0": 2.0}


def query(docs: DataFrame) -> DataFrame:
    return replicate(docs, WEIGHTS).drop("rate")
