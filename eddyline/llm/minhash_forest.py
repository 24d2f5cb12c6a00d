"""Near-duplicate groups through an LSH forest of MinHash signatures.

A document's set is its distinct word shingles (5 words, A-Z lower-cased). Two documents are
linked when their sets have a Jaccard similarity of 0.75 or more; groups are the connected
components. The steps:

1. One pass over the whole texts gives each document its set's size and 64-bit fingerprint
   and a MinHash signature. Documents with equal sets are one *class* from here on, so
   copies cost nothing more.
2. Forest: every class stands in ``TREES`` sorted orders, one per tree; its label there is a
   run of ``DEPTH`` signature values. The orders are sorted by range partitioning, which
   splits a region of any size. Classes that share at least ``BASE`` leading values form a
   region. A region of up to ``REGION`` + 1 classes proposes all its pairs. In a larger one
   the depth adapts: sub-regions are deepened value by value until they are that small, and
   all its classes are compared with the region's hubs (the classes that agree most with the
   majority signature: the text that the others were copied from). So proposals stay linear
   in the size of a region.
3. Proposed pairs are confirmed on full sets (exact intersection); sets are made in a second
   pass only for classes that were proposed.
4. All classes of dense regions are joined exactly by their rarest shingles (a prefix filter),
   across components only: whatever rounds 1 to 3 left out there is found. A pair that meets is
   asked for only if the place of the shingle and the bitmaps of both sets (a bit that one has and
   the other lacks is a shingle that is not common) leave room for the threshold, so sets that
   share a passage in otherwise different texts are told apart before a set is fetched.

With 24 trees and a base depth of 3, a pair of similarity 0.75 meets in no tree with a chance
of (1 - 0.75**3)**24 = 2e-6. What meets in dense regions only is left to no chance: step 4.

Defined cases: a null text and a text without words have no set, are linked with nothing and
stay; fewer than 5 words are one shingle; repeated rows and equal texts share a class; the
id of a group is its smallest non-null doc_id (a null id never represents others); columns
of the input are not touched; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline._ship import ship_by_value
from eddyline.llm.common import WordHashes, attach, byte_values, map_batches, map_rows, window_hashes
from eddyline.llm.components import components
from eddyline.session import materialize, target_parallelism

SHINGLE = 5
PERCENT = 75
TREES = 24
BASE = 3
DEPTH = 8
VALUES = TREES * BASE  # of a signature
REGION = 16
HUBS = 4
BLOCK = 4096  # classes of a dense region whose majority is taken together
SEED = 20240607
FILTER_BITS = 1 << 24  # fixed size (2 MB) of the filter that saves making sets nobody asked for
CHUNK = 1 << 15  # shingles hashed at once
OFTEN = 1 << 20  # shingles whose frequency orders the exact join, at most (16 MB)
SALT = 256  # indexed sets of one shingle and size band that are compared in one place
BITMAP = 32  # longs of a set's bitmap
SPLIT = 500  # pairs of one set that are confirmed in one place, at least
BAND = 1.05 * 100 / PERCENT  # sets of linked classes are at most one size band apart

_random = np.random.default_rng(SEED)
FACTORS = (_random.integers(0, 1 << 32, VALUES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
OFFSETS = _random.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)


# ---------------------------------------------------------------- sets and signatures


def shingles(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    words = (text or b"").lower().split()  # A-Z only; [\x20\x09-\x0D] only
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes.of(words), min(SHINGLE, len(words))))


def fingerprint(values: np.ndarray) -> int:
    return np.uint64(xxhash.xxh3_64_intdigest(values.tobytes())).view(np.int64).item()


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of VALUES minima per (non-empty) set."""
    out = np.empty((len(sets), VALUES), np.uint32)
    at = 0
    while at < len(sets):
        to, n = at, 0
        while to < len(sets) and (n == 0 or n + len(sets[to]) <= CHUNK):
            n += len(sets[to])
            to += 1
        lengths = [len(s) for s in sets[at:to]]
        starts = np.cumsum([0, *lengths[:-1]])
        x = (np.concatenate(sets[at:to]) >> np.uint64(32)).astype(np.uint32)
        y = np.empty_like(x)
        for k in range(VALUES):
            np.multiply(x, FACTORS[k], out=y)
            np.add(y, OFFSETS[k], out=y)
            out[at:to, k] = np.minimum.reduceat(y, starts)
        at = to
    return out


def profile(docs: DataFrame, text: str, ids: list[str]) -> DataFrame:
    """(ids, n_shingles, set_hash, signature) per document; no set: null hash and signature."""
    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_hash", T.LongType()),
        T.StructField("signature", T.BinaryType()),
    ]

    def make():
        hashes = WordHashes()

        def step(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            sets = [shingles(b, hashes) for b in byte_values(batch.column(text))]
            full = [s for s in sets if len(s)]
            made = iter(signatures(full).astype(">u4")) if full else iter(())
            return {
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "set_hash": pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()),
                "signature": pa.array([next(made).tobytes() if len(s) else None for s in sets], pa.binary()),
            }

        return step

    return map_rows(docs.select(*ids, text), make, fields, by=text, keep=ids)


# ---------------------------------------------------------------- the sorted orders

PAIR, DENSE, EDGE = 0, 1, 2
FOUND = "kind int, a long, b long, tree int, label binary"


def pairs_within(run: np.ndarray, chosen: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j <= i + reach, of the same run, both chosen."""
    left, right = [], []
    for k in range(1, min(reach, len(run) - 1) + 1):
        i = np.flatnonzero((run[:-k] == run[k:]) & chosen[:-k] & chosen[k:])
        left.append(i)
        right.append(i + k)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, np.int64),) * 2


def same_region(tree: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Does row i+1 share tree and base prefix with row i?"""
    same = tree[1:] == tree[:-1]
    for d in range(BASE):
        same &= label[1:, d] == label[:-1, d]
    return same


def numbered(same: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(~same)])


def propose(tree: np.ndarray, label: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Of rows sorted by (tree, label): proposed pairs, and which rows stand in a dense region."""
    same = same_region(tree, label)
    open_rows = dense = np.ones(len(tree), bool)
    pairs = []
    for depth in range(BASE, DEPTH + 1):
        if depth > BASE:
            same = same & (label[1:, depth - 1] == label[:-1, depth - 1])
        run = numbered(same)
        small = np.bincount(run)[run] <= REGION + 1
        pairs.append(pairs_within(run, open_rows & small, REGION))
        open_rows = open_rows & ~small
        if depth == BASE:
            dense = open_rows
        if not open_rows.any():
            break
    return pairs, dense


def forest(classes: DataFrame, partitions: int) -> DataFrame:
    """Proposals of all trees, as rows of FOUND."""
    wrapped = F.concat("signature", F.substring("signature", 1, 4 * DEPTH))
    rows = classes.select(
        "set_hash", wrapped.alias("values"), F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    ).select("tree", F.expr(f"substring(values, tree * {4 * BASE} + 1, {4 * DEPTH})").alias("label"), "set_hash")
    rows = rows.repartitionByRange(partitions, "tree", "label", "set_hash")
    rows = rows.sortWithinPartitions("tree", "label", "set_hash")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a range partition: bounded by the partition count, however large a region is
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        tree, node = table["tree"].to_numpy(), table["set_hash"].to_numpy()
        names = table["label"].to_pylist()
        label = np.frombuffer(b"".join(names), ">u4").reshape(-1, DEPTH)
        pairs, dense = propose(tree, label)

        def rows_of(kind: int, a, b=None, at=None) -> pa.RecordBatch:
            none = lambda t: pa.nulls(len(a), t)
            columns = [
                pa.array(np.full(len(a), kind, np.int32)),
                pa.array(a, pa.int64()),
                none(pa.int64()) if b is None else pa.array(b, pa.int64()),
                none(pa.int32()) if at is None else pa.array(tree[at], pa.int32()),
                none(pa.binary()) if at is None else pa.array([names[i] for i in at], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["kind", "a", "b", "tree", "label"])

        for i, j in pairs:
            yield rows_of(PAIR, node[i], node[j])
        where = np.flatnonzero(dense)
        yield rows_of(DENSE, node[where], at=where)
        # the regions at both ends may go on in other partitions: all rows of a small one, one of a dense one
        run = numbered(same_region(tree, label))
        for r in {0, int(run[-1])}:
            at = np.flatnonzero(run == r)
            at = at[:1] if dense[at[0]] else at
            yield rows_of(EDGE, node[at], dense[at].astype(np.int64), at=at)

    return map_batches(rows, scan, FOUND)


def cut_regions(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs(a, b), rows(tree, label, a)) of the regions that borders cut: all pairs of a region that
    is small as a whole, the rows that lie in a dense one without having been known to."""
    part = [F.col("tree"), F.substring("label", 1, 4 * BASE).alias("prefix")]
    whole = found.where(F.col("kind") == EDGE).groupBy(*part).agg(
        (F.max("b") == 1).alias("dense"),
        # small pieces only: at most REGION + 1 rows per border
        F.sort_array(F.collect_list(F.when(F.col("b") == 0, F.struct("label", "a")))).alias("rows"),
    )
    dense = F.col("dense") | (F.size("rows") > REGION + 1)
    members = whole.where(dense).select("tree", F.inline("rows"))
    small = whole.where(~dense & (F.size("rows") > 1)).select(F.posexplode("rows").alias("i", "x"), "rows")
    pairs = small.select(F.col("x.a").alias("a"), F.explode(F.expr("slice(rows, i + 2, size(rows))")).alias("y"))
    return pairs.select("a", F.col("y.a").alias("b")), members


def hub_pairs(dense: DataFrame, classes: DataFrame) -> DataFrame:
    """Every class of a dense region (``dense(tree, label, a)``) with the region's hubs."""
    region = F.xxhash64("tree", F.substring("label", 1, 4 * BASE)).alias("region")
    members = materialize(dense.select(region, F.col("a").alias("set_hash")))
    sizes = materialize(members.groupBy("region").agg(F.count(F.lit(1)).alias("rows")))
    blocks = sizes.withColumn("blocks", F.ceil(F.col("rows") / BLOCK))
    signed = attach(members, blocks, ["region"], "rows").join(classes.select("set_hash", "signature"), "set_hash")
    signed = signed.withColumn("block", F.pmod(F.xxhash64("set_hash"), F.col("blocks")))

    def rank(key: tuple[pa.Scalar, pa.Scalar], table: pa.Table) -> pa.Table:
        values = np.frombuffer(b"".join(table["signature"].to_pylist()), ">u4").reshape(-1, VALUES)
        score = np.zeros(len(values), np.int64)
        for k in range(VALUES):
            value, count = np.unique(values[:, k], return_counts=True)
            score += values[:, k] == value[np.argmax(count)]
        best = np.argsort(-score, kind="stable")[: 2 * HUBS]
        return pa.table({
            "region": pa.array([key[0].as_py()] * len(best), pa.int64()),
            "hub": table["set_hash"].to_numpy()[best],
            "score": score[best],
        })

    ranked = signed.groupBy("region", "block").applyInArrow(rank, "region long, hub long, score long")
    best = F.max(F.struct("score", "hub")).alias("best")
    hubs = ranked.groupBy("region", F.pmod("hub", F.lit(HUBS)).alias("part")).agg(best).select("region", "best.hub")
    hubs = hubs.groupBy("region").agg(F.collect_list("hub").alias("hubs")).join(sizes, "region")  # HUBS at most
    return attach(members, materialize(hubs), ["region"], "rows").select(F.col("set_hash").alias("a"), F.explode("hubs").alias("b"))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


# ---------------------------------------------------------------- the exact join


def probe_length(n):
    """Of a set of n in the common order, the first shingle shared with a linked set that is not
    larger stands among so many."""
    return n - (PERCENT * n + 99) // 100 + 1


def index_length(n):
    """The same with a linked set that is not smaller."""
    return n - (2 * PERCENT * n + 99 + PERCENT) // (100 + PERCENT) + 1


def rarest(values: np.ndarray, often: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probe prefix of a set, rarest shingles first, and their counts (0: not in ``often``)."""
    count = np.zeros(len(values), np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, values), len(often) - 1)
        count = np.where(often[at] == values, counts[at], 0)
    first = np.lexsort((values, count))[: probe_length(len(values))]
    return values[first], count[first]


def prefixes(members: DataFrame) -> DataFrame:
    """(shingle, node, root, n, indexed, at, band) of the probe prefixes of ``members(node, root, shingles)``;
    shingles known to be in one set only keep their places but give no rows."""
    total = members.agg(F.sum(F.size("shingles"))).first()[0] or 0
    counted = members.select(F.explode("shingles").alias("shingle")).groupBy("shingle").count()
    least = max(2, -(-total // OFTEN))
    counted = counted.where(F.col("count") >= least).toArrow()  # at most OFTEN rows
    by = np.argsort(counted["shingle"].to_numpy())
    table = (counted["shingle"].to_numpy()[by], counted["count"].to_numpy()[by])
    shared = members.sparkSession.sparkContext.broadcast(table)
    names = ["shingle", "node", "root", "n", "indexed", "at", "band"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = shared.value
        for batch in batches:
            nodes, roots = batch.column("node").to_numpy(), batch.column("root").to_numpy()
            waiting, rows = [], 0
            for i, values in enumerate(batch.column("shingles")):
                values = values.values.to_numpy()
                (first, count), n = rarest(values, often, counts), len(values)
                at = np.flatnonzero(count > 0) if least == 2 else np.arange(len(first))
                fixed = (nodes[i], roots[i], n, index_length(n), int(np.log(n) / np.log(BAND)))
                node, root, size, indexed, band = (np.full(len(at), v, np.int64) for v in fixed)
                waiting.append((first[at], node, root, size, indexed, at, band))
                rows += len(at)
                if rows >= CHUNK or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*waiting, strict=True)], names=names)
                    waiting, rows = [], 0

    return map_batches(members, run, ", ".join(f"{n} long" for n in names))


def bitmap(values: np.ndarray) -> np.ndarray:
    """BITMAP longs with a bit per shingle (several may share one)."""
    bits = np.zeros(64 * BITMAP, np.uint8)
    bits[(values.view(np.uint64) >> np.uint64(40)) % np.uint64(64 * BITMAP)] = 1
    return np.packbits(bits).view(np.int64)


def bitmaps(members: DataFrame) -> DataFrame:
    """(node, bits) of ``members(node, shingles)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [bitmap(v.values.to_numpy()) for v in batch.column("shingles")]
            bits = pa.array(made, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), bits], names=["node", "bits"])

    return map_batches(members.select("node", "shingles"), run, "node long, bits array<long>")


def room(n: str, n_y: str, x: str, y: str) -> str:
    """Condition: can sets of ``n`` and ``n_y`` shingles with these bitmaps be similar enough? A bit that
    only one has stands for a shingle of its own."""
    only = lambda p, q: " + ".join(f"bit_count({p}[{i}] & ~{q}[{i}])" for i in range(BITMAP))
    need = f"{PERCENT} * ({n} + {n_y})"
    return f"{100 + PERCENT} * ({n} - ({only(x, y)})) >= {need} and {100 + PERCENT} * ({n_y} - ({only(y, x)})) >= {need}"


def exact_pairs(nodes: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair of dense classes (``nodes(node)``) in different components that may be similar enough.

    Sets probe, in their own and the next smaller size band, the index of sets that are not
    larger. A cell (shingle, band) of one component is left out; in the others the members of
    the most frequent component are not compared with each other, and the index is dealt over
    salts. The bounds are part of the join's condition: pairs without room are never rows."""
    nodes = nodes.join(groups, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    members = materialize(sets.withColumnRenamed("set_hash", "node").join(nodes, "node").select("node", "root", "shingles"))
    posted = materialize(prefixes(members))
    step = F.expr("explode(sequence(0, 1))").alias("step")
    probes = posted.select("*", step).withColumn("band", F.col("band") - F.col("step")).drop("step")
    index = posted.where("at < indexed").drop("indexed")
    cell = ["shingle", "band"]
    both = probes.select(*cell, "root", F.lit(0).alias("indexed")).union(index.select(*cell, "root", F.lit(1)))
    parts = both.groupBy(*cell, "root").agg(F.count(F.lit(1)).alias("rows"), F.sum("indexed").alias("indexed"))
    cells = parts.groupBy(*cell).agg(
        F.max(F.struct("rows", "root"))["root"].alias("main"),
        F.ceil(F.sum("indexed") / SALT).alias("salts"),
        F.count(F.lit(1)).alias("roots"),
    )
    cells = materialize(cells.where("roots > 1 and salts > 0").drop("roots"))
    marks = materialize(bitmaps(members))
    left = probes.join(cells, cell).join(marks, "node").withColumn("side", F.expr("cast(root = main as int)"))
    left = left.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    right = index.join(cells, cell).join(marks, "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")))
    right = right.withColumn("side", F.explode(F.expr("if(root = main, array(0), array(0, 1))")))
    x = left.select(*cell, "side", "salt", "node", "root", "n", "at", "bits").alias("x")
    y = right.select(*cell, "side", "salt", "node", "root", "n", "at", "bits").alias("y")
    same = " and ".join(f"x.{c} = y.{c}" for c in [*cell, "side", "salt"])
    smaller = "x.root <> y.root and (x.n > y.n or x.n = y.n and x.node > y.node)"
    # what can still be common from a first shared shingle on
    ahead = f"{100 + PERCENT} * least(x.n - x.at, y.n - y.at) >= {PERCENT} * (x.n + y.n)"
    met = x.join(y, F.expr(f"{same} and {smaller} and {ahead} and {room('x.n', 'y.n', 'x.bits', 'y.bits')}"))
    return ordered(met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))


# ---------------------------------------------------------------- confirmation


def asked_sets(docs: DataFrame, text: str, text_hash: str, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(set_hash, shingles) of the classes that occur in ``pairs``, from one document each."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("set_hash")).distinct()
    position = F.pmod(F.col("text_hash"), F.lit(FILTER_BITS)) + 1
    bits = (
        classes.join(nodes, "set_hash", "left_semi")
        .groupBy(F.bitmap_bucket_number(position).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bits"))
    )
    whole = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in bits.collect():  # at most FILTER_BITS / 32768 rows of 4 KB
        whole[(row["bucket"] - 1) * 4096 : row["bucket"] * 4096] = np.frombuffer(row["bits"], np.uint8)
    wanted = docs.sparkSession.sparkContext.broadcast(whole.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, hashes, done = np.frombuffer(wanted.value, np.uint8), WordHashes(), set()
        for batch in batches:
            h = batch.column(text_hash).to_numpy()
            at = h & (FILTER_BITS - 1)
            for i in np.flatnonzero((have[at >> 3] >> (at & 7).astype(np.uint8)) & 1):
                if h[i] in done:
                    continue
                done.add(h[i])
                s = shingles(byte_values(batch.column(text).slice(i, 1))[0], hashes)
                if len(s):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([fingerprint(s)], pa.int64()), pa.array([s.view(np.int64)], pa.list_(pa.int64()))],
                        names=["set_hash", "shingles"],
                    )

    made = map_batches(docs.select(text, text_hash), run, "set_hash long, shingles array<long>")
    return made.join(nodes, "set_hash", "left_semi").groupBy("set_hash").agg(F.first("shingles").alias("shingles"))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough. A set that very many pairs ask for (a hub) is
    dealt over salts, on the way to either end."""
    total = pairs.count()
    limit = max(SPLIT, total // target_parallelism(pairs.sparkSession))

    def with_sets(rows: DataFrame, end: str, other: str, name: str) -> DataFrame:
        asked = rows.groupBy(end).agg(F.ceil(F.count(F.lit(1)) / limit).alias("salts")).where("salts > 1")
        # fewer than total / limit rows, so fewer than there are shuffle partitions
        asked = F.broadcast(materialize(asked))
        salt = F.pmod(F.xxhash64(other), F.coalesce("salts", F.lit(1).cast("long"))).alias("salt")
        dealt = rows.join(asked, end, "left").select(*rows.columns, salt)
        given = sets.select(F.col("set_hash").alias(end), F.col("shingles").alias(name)).join(asked, end, "left")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1).cast("long")) - 1)).alias("salt")
        return dealt.join(given.select(end, name, every), [end, "salt"]).drop("salt")

    both = with_sets(with_sets(pairs, "b", "a", "y"), "a", "b", "x")
    both = both.where(100 * F.least(F.size("x"), F.size("y")) >= PERCENT * F.greatest(F.size("x"), F.size("y")))
    common = F.size(F.array_intersect("x", "y"))
    return both.where(100 * common >= PERCENT * (F.size("x") + F.size("y") - common)).select("a", "b")


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups(node, root)`` with more links: only the roots they join are contracted anew."""
    for end in ("a", "b"):
        names = groups.select(F.col("node").alias(end), F.col("root").alias("top"))
        links = links.join(names, end, "left").withColumn(end, F.coalesce("top", end)).drop("top")
    tops = components(links.select("a", "b"))
    every = groups.union(tops.join(groups, "node", "left_anti").select("node", F.col("node").alias("root")))
    tops = tops.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return materialize(every.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root")))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) per row of ``docs``; text_hash is
    xxhash64 of the text, so rows of one id with different texts can be told apart."""
    spark = docs.sparkSession
    hashed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    slim = materialize(profile(hashed, "text", ["doc_id", "text_hash"]))
    classes = materialize(
        slim.where("n_shingles > 0").groupBy("set_hash").agg(
            F.min("doc_id").alias("first_id"), F.min("text_hash").alias("text_hash"), F.first("signature").alias("signature"),
            F.count(F.lit(1)).alias("copies"),
        )
    )
    rows = classes.count() * TREES
    width = target_parallelism(spark)
    partitions = max(1, min(max(width, rows // 1_000_000), rows // 1000))
    found = materialize(forest(classes, partitions))
    cut, cut_rows = cut_regions(found)
    dense = materialize(found.where(F.col("kind") == DENSE).select("tree", "label", "a").unionByName(cut_rows).distinct())
    first = found.where(F.col("kind") == PAIR).select("a", "b").union(cut).union(hub_pairs(dense, classes))
    first = materialize(ordered(first))
    sets = materialize(asked_sets(hashed, "text", "text_hash", classes, first))
    groups = components(confirmed(first, sets))
    nodes = materialize(dense.select(F.col("a").alias("node")).distinct())
    if nodes.count():
        # every class of a dense region was compared with a hub, so its set is there
        groups = merged(groups, confirmed(materialize(exact_pairs(nodes, groups, sets)), sets))
    named = classes.select("set_hash", "first_id").join(groups.withColumnRenamed("node", "set_hash"), "set_hash")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    grouped = named.join(smallest, "root").select("set_hash", "component_id")
    known = classes.select("set_hash", "first_id", "copies").join(grouped, "set_hash", "left")
    known = materialize(known.select("set_hash", F.coalesce("component_id", "first_id").alias("component_id"), "copies"))
    # a class may hold a third of all documents
    out = attach(slim.select("doc_id", "text_hash", "n_shingles", "set_hash"), known, ["set_hash"], "copies", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stand for their group, one row per (id, text); the texts are
    shuffled once, by id."""
    keys = ["_id_hash", "_text_hash"]  # never null, on both sides
    chosen = near_duplicates(docs, text, doc_id).where("kept")
    chosen = chosen.select(F.xxhash64("doc_id").alias(keys[0]), F.col("text_hash").alias(keys[1])).distinct()
    hashed = docs.withColumn(keys[0], F.xxhash64(doc_id)).withColumn(keys[1], F.xxhash64(text))
    # rows that repeat id and text: one stays (they are dealt by the same keys already)
    return hashed.join(chosen, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


ship_by_value(__name__)
