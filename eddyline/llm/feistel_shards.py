"""Reproducible shuffle and sharding by a Feistel permutation over global row numbers.

1. Every row gets a global number 0..n-1 that depends on the rows alone, not on files or
   partitions: rows are dealt to ``BUCKETS`` buckets by a hash of all their key columns,
   numbered inside their bucket by a sort on the same columns, and the buckets' running
   totals (a table of at most ``BUCKETS`` rows) are added. Equal rows are counted first and
   unfolded after the numbering, so any number of copies is one row in the sort.
2. ``permuted`` maps a number through a balanced Feistel network over pairs (left, right) in
   0..m-1, m = ceil(sqrt(n)). Values from n to m*m-1 walk on through the network until they
   fall below n (cycle walking). A walk meets each of the m*m - n surplus values at most
   once, so that many steps always suffice; they are only taken by the few numbers (about
   2 / sqrt(n) of all) that leave the range.
3. Position p is in shard p mod shards at slot p div shards: sizes differ by one row at most,
   slots have no gaps, and ``locate`` computes both for any row number.

Only DataFrame expressions are used. Defined cases: null keys take part as values of their
own; repeated rows get numbers of their own (which of them gets which does not matter, they
are equal); an empty table gives an empty result; more shards than rows leave shards empty.
Columns called like a result column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.session import materialize

BUCKETS = 4096
ROUNDS = 6
UNFOLD = 4096  # copies unfolded from one array
SHARDS = 24
SEED = 20240607


def half(n: int) -> int:
    """Side of the square that the network permutes."""
    return max(1, math.isqrt(max(n, 1) - 1) + 1)


def network(value: Column, m: int, seed: int) -> Column:
    """One pass of the Feistel network over 0..m*m-1."""
    quotient = ((value - value % F.lit(m)) / F.lit(m)).cast("long")  # exact below 2**53
    start = F.struct(quotient.alias("l"), (value % F.lit(m)).cast("long").alias("r"))

    def turn(state: Column, k: Column) -> Column:
        noise = F.pmod(F.xxhash64(state["r"], k, F.lit(seed)), F.lit(m))
        return F.struct(state["r"].alias("l"), F.pmod(state["l"] + noise, F.lit(m)).alias("r"))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)
    return end["l"] * F.lit(m) + end["r"]


def permuted(number: Column, n: int, seed: int = SEED) -> Column:
    """Where the permutation of 0..n-1 sends a row number."""
    m = half(n)
    once = network(number, m, seed)
    surplus = m * m - n
    if surplus <= 0:
        return once
    # as many turns as there are surplus values; written over the row, so that the plan does
    # not hold the list, and made only for a value that left the range
    turns = F.sequence(F.lit(1), F.when(number >= 0, F.lit(surplus)).otherwise(F.lit(1)))

    def walk(value: Column) -> Column:
        end = F.aggregate(turns, value, lambda at, _: F.when(at < n, at).otherwise(network(at, m, seed)))
        return F.when(value < n, value).otherwise(end)

    return F.element_at(F.transform(F.array(once), walk), 1)


def locate(number: Column, n: int, shards: int, seed: int = SEED) -> tuple[Column, Column]:
    """(shard, slot) of a row number."""
    at = permuted(number, n, seed)
    return (at % shards).cast("int"), F.floor(at / shards).cast("long")


def number_rows(df: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """``df.select(keys)`` with ``row_number`` (0-based, gapless), and the row count."""
    folded = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    folded = materialize(folded.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")))
    sizes = folded.groupBy("_bucket").agg(F.sum("_copies").alias("_size"))
    # at most BUCKETS rows; their running total is taken over that small table
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"), "_size")
    n = totals.agg(F.sum("_size")).first()[0] or 0
    inside = Window.partitionBy("_bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    numbered = folded.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    numbered = numbered.join(F.broadcast(totals.select("_bucket", "_start")), "_bucket")
    first = F.col("_start") + F.col("_before")
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / UNFOLD)))
    numbered = numbered.select(*keys, first.alias("_first"), "_copies", chunk.alias("_chunk"))
    low = F.col("_chunk") * UNFOLD
    each = F.explode(F.sequence(low, F.least(low + UNFOLD, F.col("_copies")) - 1))
    numbered = numbered.select(*keys, "_first", each.alias("_each"))
    return numbered.select(*keys, (F.col("_first") + F.col("_each")).alias("row_number")), n


def shard_rows(df: DataFrame, keys: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The key columns with ``row_number``, ``position`` (after the shuffle), ``shard``, ``slot``."""
    numbered, n = number_rows(df, keys)
    placed = numbered.withColumn("position", permuted(F.col("row_number"), n, seed))
    return placed.withColumn("shard", (F.col("position") % shards).cast("int")).withColumn(
        "slot", F.floor(F.col("position") / shards).cast("long")
    )


def query(docs: DataFrame) -> DataFrame:
    raw = F.col("text").cast("binary")
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.length(raw), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(raw, F.lit(b""))).alias("text_crc32"),
    )
    out = shard_rows(slim, ["doc_id", "size", "text_crc32"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
