"""Chat formatting with collapse of cumulative snapshots.

A logging client often writes a conversation again after every turn, so the log holds prefixes
of the same conversation. Each turn gets a rolling hash of the conversation up to it (two
64-bit XOR sums over position, role and text, by a prefix scan that cuts hot conversations). A conversation
whose last hash is found among the inner prefixes of another is a snapshot of a longer one and
goes, by an anti-join on (turns, hashes); of equal conversations the smallest conv_id stays.
What is left is rendered turn by turn with the template.

Inner prefixes and equal conversations are brought down to distinct values with partial
aggregation first, so a first turn that a third of all conversations share is one row per task.

Defined cases: a turn without conv_id is a conversation of its own (id null); a null role or
text is the empty string; turns with the same number (also null) are ordered by role and text;
repeated rows are turns of their own; an empty table gives an empty result; other columns are
not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.prefix import Buckets, Running, assign_buckets, running
from eddyline.session import materialize

START, END = "<|im_start|>", "<|im_end|>"


def rendered(turns: Column) -> Column:
    """The template over an ordered array of (role, text)."""
    one = lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))
    return F.array_join(F.transform(turns, one), "")


def rolling(turns: DataFrame) -> DataFrame:
    """Turns with ``at`` (1-based), ``h1``, ``h2`` of the conversation up to here and ``is_last``. A
    conversation that holds more than a task's share of the turns is cut into ranges of ``turn``."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    # a turn that names no conversation stands alone
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    rows = materialize(rows.withColumn("_alone", alone))
    keys, order, one = ["conv_id", "_alone"], ["turn", "role", "text"], F.lit(1)
    cut = assign_buckets(rows, keys, ["turn"])
    counts = [Running("at", "count", one), Running("n", "count", one, whole=True)]
    placed = running(None, keys, order, counts, keep_buckets=True, buckets=cut)
    for name, seed in (("_x1", 1), ("_x2", 2)):
        placed = placed.withColumn(name, F.xxhash64(F.lit(seed), "at", F.length("role"), "role", "text"))
    hashes = [Running("h1", "xor", "_x1"), Running("h2", "xor", "_x2")]
    out = running(None, keys, order, hashes, buckets=Buckets(placed, keys, cut.any_hot, dealt=True))
    return out.select(*keys, "role", "text", F.col("at").cast("int").alias("at"), "h1", "h2", (F.col("at") == F.col("n")).alias("is_last"))


def maximal(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies, h1, h2) of the conversations of ``rolling`` that are no prefix of a
    longer one."""
    marked = rows.select("conv_id", "at", "h1", "h2", "is_last")
    whole = marked.where("is_last").groupBy("at", "h1", "h2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")
    )
    inner = marked.where("not is_last").select("at", "h1", "h2").distinct()
    kept = whole.join(inner, ["at", "h1", "h2"], "left_anti")
    return kept.select("conv_id", F.col("at").cast("long").alias("n_turns"), "copies", "h1", "h2")


def chats(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies, text): the maximal conversations, rendered.

    One row's turns are gathered, as the result is one text per conversation."""
    rows = materialize(rolling(turns))
    kept = maximal(rows)
    named = kept.where("conv_id is not null").select("conv_id", "n_turns", "copies")
    gathered = F.sort_array(F.collect_list(F.struct("at", "role", "text")))
    out = (
        rows.where("conv_id is not null")
        .join(named, "conv_id")
        .groupBy("conv_id", "n_turns", "copies")
        .agg(rendered(gathered).alias("text"))
    )
    single = kept.where("conv_id is null").select("copies", "h1", "h2", "n_turns")
    lone = rows.where("conv_id is null").dropDuplicates(["h1", "h2"]).join(single, ["h1", "h2"])
    lone = lone.select("conv_id", "n_turns", "copies", rendered(F.array(F.struct("role", "text"))).alias("text"))
    return out.unionByName(lone)


def query(conversations: DataFrame) -> DataFrame:
    return chats(conversations).withColumn("n_chars", F.length("text").cast("long"))
