"""Prefix trie of conversations, with count-min screening of the prefix digests.

A node of the trie is a distinct sequence of first turns; its members are the conversations that
start with it. Every turn carries the digest of its conversation up to itself (two XOR sums of
hashes over position and turn, made by a prefix scan that cuts hot conversations).

1. Screening: a count-min sketch of all prefix digests. It never counts too little, so an estimate
   of one proves that no other conversation has the prefix, nor any longer one: such tails are
   nodes of one member and are emitted where they stand. Only prefixes that may be shared are
   shuffled and grouped exactly, so a false alarm of the sketch costs a row, not a result.
2. The exact groups give each shared prefix its representative (the smallest member) and its
   counts. A conversation represents its own path from some depth on and none above it; that depth,
   the words before it and the node just above say all that is needed of a conversation.
3. A node's children, leaves and saved words are then plain sums over its members: a child or a
   leaf is counted at the member that represents it, and repeated words at the members that do
   not. So no level-by-level pass, whatever the depth.

Hot keys: grouping is preceded by partial aggregation; what is brought back to the rows by key
(a prefix that a third of all conversations share, a conversation that holds a third of all turns)
is broadcast for keys above ``rows / P``, of which there are at most P, and joined otherwise. The
member lists of a node are hashed as pieces: ranges of (node, id) are joined to text in parallel,
and only the finished pieces of a node meet, one after the other.

Exactness: prefixes are known by 128 bits of hashes.

Defined cases: rows without a conv_id belong to no conversation and are left out; a null role or
text is empty; turns with the same number (also null, which come first) are ordered by their md5;
repeated rows are turns of their own; conversations without turns are members of the root only;
no conversations give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline._ship import ship_by_value
from eddyline.llm.common import attach, map_batches
from eddyline.operators.prefix import Running, running
from eddyline.session import materialize, target_parallelism

# The sketch: fixed size at any number of prefixes. SLICES parts by hash (each merged on its own),
# ROWS rows of WIDTH counters each; the screen made of it has one bit per counter (384 KB).
SLICES = 64
ROWS = 3
WIDTH = 1 << 14
SKETCH_SEED = 7
PIECE = 4096  # ids of one piece of a member list
MERSENNE = np.int64((1 << 31) - 1)
NOBODY = hashlib.sha256(b"").hexdigest()
NODE = ["k1", "k2", "depth"]
HEADS = 3  # turns of another conversation that a rebuilt one starts with, at most
FAMILY = 20


# ---------------------------------------------------------------- the sketch


def screen(digests: DataFrame) -> np.ndarray:
    """Bits (SLICES, ROWS, WIDTH): is the counter at most one? From the sketches of ``k1``, which
    are merged by slices; only the bits come to the driver."""
    sketch = F.count_min_sketch("k1", F.lit(2.0 / WIDTH), F.lit(1 - 2.0 ** (0.5 - ROWS)), F.lit(SKETCH_SEED))
    parts = digests.groupBy(F.pmod("k1", F.lit(SLICES)).alias("slice")).agg(sketch.alias("sketch"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(counters(s.as_py())[1] <= 1).tobytes() for s in batch.column("sketch")]
            yield pa.RecordBatch.from_arrays([batch.column("slice"), pa.array(bits, pa.binary())], names=["slice", "bits"])

    out = np.full((SLICES, ROWS, WIDTH), True)
    for row in map_batches(parts, run, "slice long, bits binary").collect():  # SLICES rows of fixed size
        out[row["slice"]] = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).reshape(ROWS, WIDTH)
    return out


def counters(sketch: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash factors and counters of a serialized sketch (its documented first version: version,
    total, depth, width, a factor per row, the rows; big-endian)."""
    depth, width = np.frombuffer(sketch, ">i4", 2, 12)
    factors = np.frombuffer(sketch, ">i8", depth, 20).astype(np.int64)
    return factors, np.frombuffer(sketch, ">i8", depth * width, 20 + 8 * depth).reshape(depth, width).astype(np.int64)


def factors_of(spark) -> np.ndarray:
    """The sketch's hash factors, which depend on its seed only."""
    one = F.count_min_sketch("id", F.lit(2.0 / WIDTH), F.lit(1 - 2.0 ** (0.5 - ROWS)), F.lit(SKETCH_SEED))
    return counters(bytes(spark.range(1).agg(one).first()[0]))[0]


def proven_single(k1: np.ndarray, bits: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Is the sketch's estimate of a digest one?"""
    out = np.zeros(len(k1), bool)
    part = np.mod(k1, SLICES)
    for r in range(ROWS):
        h = factors[r] * k1
        h += h >> np.int64(32)
        out |= bits[part, r, (h & MERSENNE) % WIDTH]
    return out


def screened(rows: DataFrame) -> DataFrame:
    """``rows`` with ``alone`` (the prefix is proven to have one member) and ``first`` (and the
    one above it is not)."""
    bits = screen(rows)
    factors = factors_of(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool).reshape(SLICES, ROWS, WIDTH)
        for batch in batches:
            alone = proven_single(batch.column("k1").to_numpy(), held, factors)
            above = proven_single(batch.column("up1").to_numpy(), held, factors)
            first = (batch.column("depth").to_numpy() == 1) | ~above
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(alone), pa.array(alone & first)], names=[*names, "alone", "first"]
            )

    schema = T.StructType([*rows.schema.fields, T.StructField("alone", T.BooleanType()), T.StructField("first", T.BooleanType())])
    return map_batches(rows, run, schema)


# ---------------------------------------------------------------- member lists


def member_hashes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ends_sha256) of ``rows(keys, conv_id)``: the sha256 of each key's ids, ascending."""
    spark = rows.sparkSession
    names = [*keys, "conv_id"]
    fields = ", ".join(f"{k} long" for k in keys)
    ranged = rows.select(*names).repartitionByRange(target_parallelism(spark), *names).sortWithinPartitions(*names)

    def runs_of(columns: list[np.ndarray]) -> list[int]:
        n = len(columns[0])
        new = np.ones(n, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        return [*np.flatnonzero(new).tolist(), n]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy() for k in keys]
            ids = batch.column("conv_id").to_pylist()
            starts = runs_of(columns)
            cuts = [(i, j) for a, b in zip(starts, starts[1:]) for i, j in ((k, min(k + PIECE, b)) for k in range(a, b, PIECE))]
            at = np.array([i for i, _ in cuts])
            joined = [",".join(map(str, ids[i:j])) for i, j in cuts]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c[at]) for c in columns), pa.array([ids[i] for i in at], pa.int64()), pa.array(joined, pa.string())],
                names=[*keys, "first_id", "piece"],
            )

    cut = map_batches(ranged, pieces, f"{fields}, first_id long, piece string")
    met = cut.repartition(target_parallelism(spark), *keys).sortWithinPartitions(*keys, "first_id")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hasher = None, None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * (len(keys) + 1)
            types = [*[pa.int64()] * len(keys), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*keys, "ends_sha256"])

        for batch in batches:
            done = []
            for *key, piece in zip(*(batch.column(k).to_pylist() for k in [*keys, "piece"]), strict=True):
                if key != now:
                    if now is not None:
                        done.append((*now, hasher.hexdigest()))
                    now, hasher = key, hashlib.sha256()
                else:
                    hasher.update(b",")
                hasher.update(piece.encode())
            yield batch_of(done)
        if now is not None:
            yield batch_of([(*now, hasher.hexdigest())])

    return map_batches(met, digests, f"{fields}, ends_sha256 string")


# ---------------------------------------------------------------- the trie


def digested(turns: DataFrame) -> DataFrame:
    """Rows of ``turns(conv_id, at, item, words)``, ``at`` 1, 2, ... in each conversation, with the
    digest of the prefix up to each (``k1``, ``k2``), the first half of the one above it (``up1``), the
    words up to each and the length of the conversation."""
    rows = turns.withColumn("_x1", F.xxhash64(F.lit(1), "at", "item")).withColumn("_x2", F.xxhash64(F.lit(2), "at", "item"))
    one = F.lit(1)
    rows = running(rows.drop("item"), ["conv_id"], ["at"], [
        Running("k1", "xor", "_x1"), Running("k2", "xor", "_x2"), Running("upto", "sum", "words"), Running("n", "count", one, whole=True),
    ])
    return rows.select(
        "conv_id", F.col("at").cast("long").alias("depth"), "k1", "k2", F.col("k1").bitwiseXOR(F.col("_x1")).alias("up1"),
        F.col("words").cast("long").alias("words"), F.col("upto").cast("long").alias("upto"), "n",
    )


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns(conv_id, at, item, words)`` (``at`` counts 1, 2, ... in each
    conversation, ``item`` tells turns apart); ``conversations(conv_id)`` names all members."""
    members, top = conversations.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    rows = materialize(screened(materialize(digested(turns))))
    maybe = rows.where("not alone").drop("alone", "first", "up1")
    ends = F.col("depth") == F.col("n")

    # exact groups of the prefixes that may be shared
    groups = maybe.groupBy(*NODE).agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.count(F.when(ends, 1)).alias("ending")
    )
    groups = materialize(groups.withColumn("weight", F.col("size")))
    placed = materialize(attach(maybe, groups, NODE, "weight"))
    other = F.col("rep") != F.col("conv_id")
    last = F.max(F.when(other, F.struct("depth", "rep", "upto")))
    paths = placed.groupBy("conv_id").agg(
        last.alias("last"),
        F.max(ends & ~other & (F.col("size") == F.col("ending"))).alias("leaf_here"),
        F.max(ends).alias("ends_here"),
        F.count(F.lit(1)).alias("weight"),
    )
    # from depth ``own`` on the conversation represents its path
    paths = materialize(paths.select(
        "conv_id", (F.coalesce("last.depth", F.lit(0)) + 1).alias("own"), F.coalesce("last.upto", F.lit(0)).alias("before"),
        F.coalesce("last.rep", F.lit(top)).alias("above"), (F.col("leaf_here") | ~F.col("ends_here")).alias("leaf"), "weight",
    ))
    known = attach(placed, paths, ["conv_id"], "weight")
    depth, own = F.col("depth"), F.col("own")
    shared = known.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.max(F.when(~other, F.when(depth > own, F.col("conv_id")).otherwise(F.col("above")))).alias("parent_conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count(F.when((depth < F.col("n")) & (depth + 1 >= own), 1)).alias("n_children"),
        F.count(F.when(F.col("leaf"), 1)).alias("n_leaves"),
        F.sum(F.when(depth < own, F.col("before") - F.col("upto") + F.col("words")).otherwise(0)).alias("saved_tokens"),
    )
    listed = member_hashes(maybe.where(ends), NODE)
    shared = shared.join(listed, NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOBODY)))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    shared = materialize(shared.select(*columns))

    # tails: nodes of one member, as they stand; the first of a tail hangs on a shared node
    tails = rows.where("alone")
    hung = tails.where("first").join(paths.select("conv_id", "above", "own"), "conv_id", "left")
    # (a false alarm above leaves the conversation itself as the parent)
    parent = F.when(depth > F.coalesce("own", F.lit(1)), F.col("conv_id")).otherwise(F.coalesce("above", F.lit(top)))
    both = hung.withColumn("parent_conv_id", parent).drop("above", "own").unionByName(
        tails.where("not first").withColumn("parent_conv_id", F.col("conv_id"))
    )
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    single = both.select(
        "conv_id", "depth", "parent_conv_id", one.alias("n_convs"), (depth < F.col("n")).cast("long").alias("n_children"),
        one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(ends, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOBODY)).alias("ends_sha256"),
    )

    heads = shared.where("depth = 1").select("n_leaves", "saved_tokens")
    heads = heads.union(tails.where("depth = 1").select(one, zero))
    n_heads, leaves, saved = heads.agg(F.count(F.lit(1)), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    if not members:
        return shared.limit(0)
    turnless = conversations.join(turns.where("at = 1").select("conv_id"), "conv_id", "left_anti").select(zero.alias("root"), "conv_id")
    ends = member_hashes(turnless, ["root"]).agg(F.coalesce(F.max("ends_sha256"), F.lit(NOBODY)).alias("ends_sha256"))
    fixed = dict(conv_id=top, depth=0, parent_conv_id=None, n_convs=members, n_children=n_heads, n_leaves=leaves or 1, saved_tokens=saved or 0)
    root = ends.select(*[F.lit(v).cast("long").alias(c) for c, v in fixed.items()], "ends_sha256")
    return shared.unionByName(single).unionByName(root)


# ---------------------------------------------------------------- conversations


def identified(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, item, words) per turn; the item is a digest of role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    item = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return conversations.where("conv_id is not null").select("conv_id", "turn", item.alias("item"), words.cast("long").alias("words"))


def borrowed(conv_id: Column) -> Column:
    """How many first turns a rebuilt conversation takes from the first of its family."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEADS + 1))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns(conv_id, at, item, words), conversations(conv_id)) of the rebuilt conversations: the
    first ``borrowed`` turns of conversation ``c - c % 20``, then its own turns after as many."""
    one = F.lit(1)
    own = running(identified(conversations), ["conv_id"], ["turn", "item"], [Running("rank", "count", one), Running("have", "count", one, whole=True)])
    own = materialize(own.select("conv_id", "rank", "have", "item", "words").withColumn("h", borrowed(F.col("conv_id"))))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = own.where(F.col("rank") <= HEADS).where(F.col("conv_id") == base).groupBy(F.col("conv_id").alias("base"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("rank", "item", "words"))).alias("heads"))  # HEADS at most
    every = own.where("rank = 1").select("conv_id", "have", "h", base.alias("base")).join(heads, "base", "left")
    every = materialize(every.withColumn("taken", F.least("h", F.coalesce(F.size("heads"), F.lit(0))).cast("long")))
    given = every.where("taken > 0").select("conv_id", F.inline(F.expr("slice(heads, 1, int(taken))")))
    # own turns move up where the family's first conversation is shorter than what was to be taken
    short = every.where("taken < h and have > h").select("conv_id", "taken", F.col("have").alias("weight"))
    kept = attach(own.where("rank > h"), short, ["conv_id"], "weight", "left")
    place = F.col("rank") - F.col("h") + F.coalesce("taken", "h")
    turns = given.select("conv_id", F.col("rank").alias("at"), "item", "words").union(kept.select("conv_id", place, "item", "words"))
    return materialize(turns), every.select("conv_id")


def query(conversations: DataFrame) -> DataFrame:
    return trie(*rebuilt(conversations))


ship_by_value(__name__)
