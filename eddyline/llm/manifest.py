"""Merkle dataset manifest by nested-struct rollup.

Every row is a leaf: the sha256 of its fields. Rows are ranked inside their tree (by key,
ascending), and a rank is a number of digits to the base ``FAN``. The digits are grouped away
one after the other, lowest first: each grouping nests the at most ``FAN`` child structs of a
node in an array and adds the node's digest. The ``DIGITS`` groupings of one round share one
exchange by (tree, block) and one sort, so a round is a single stage after the shuffle, and a
nested row holds at most ``FAN ** DIGITS`` leaves, whatever the size of a tree. Block roots are
the leaves of the next round, the trees' roots those of the tree over all trees.

On the way down a transform walks each nested row and an explode emits its leaves with their
proofs. A block meets the proof of its own root (from the round above, at most one row a block)
by a union and a grouping on (tree, block): there is no join anywhere.

A proof is an array of (left, right): the digests that stand to the left and right of the path
at each level, joined. Folding a leaf through its proof gives the root again.

Defined cases: a null field is the text ``-``, else its UTF-8 byte count, ``:`` and the value;
rows with a null key come first in their tree, rows of one key are ordered by their leaf; rows
without a tree (a null ``lang``) are a tree of their own, the first; repeated rows are leaves of
their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.prefix import Running, running
from eddyline.session import materialize

FAN = 2  # children of a node
DIGITS = 8  # of a round: FAN ** DIGITS leaves of a nested row at most
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def levels_of(n: Column) -> Column:
    """Rounds of pairing until one of ``n`` nodes remains."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def nested(nodes: DataFrame, done: int, height: int) -> DataFrame:
    """(tree, levels, block, node) from ``nodes(tree, levels, rank, node)``, whose structs have a
    ``hash``; ``done`` levels of the trees lie below them, ``height`` more are nested."""
    digits = [(F.floor(F.col("rank") / F.lit(FAN**j)) % FAN).alias(f"d{j}") for j in range(height)]
    block = F.floor(F.col("rank") / F.lit(FAN**height)).cast("long")
    rows = nodes.select("tree", "levels", block.alias("block"), *digits, "node").repartition("tree", "block")
    for j in range(height):
        keys = ["tree", "levels", "block", *[f"d{k}" for k in range(height - 1, j, -1)]]
        places = [F.first(F.when(F.col(f"d{j}") == i, F.col("node")), ignorenulls=True) for i in range(FAN)]
        children = F.filter(F.array(*places), lambda c: c.isNotNull())
        # beyond the tree's height its root is handed on as it is
        hashed = F.col("levels") > done + j
        joined = F.array_join(F.transform(children, lambda c: c["hash"]), "")
        digest = F.when(hashed, F.sha2(joined, 256)).otherwise(children[0]["hash"])
        node = F.struct(digest.alias("hash"), hashed.alias("hashed"), children.alias("children"))
        rows = rows.groupBy(*keys).agg(node.alias("node"))
    return rows


def emitted(node: Column, height: int) -> Column:
    """Array of (node, path) for the leaves of a nested row."""
    if height == 0:
        return F.array(F.struct(node.alias("node"), F.array().cast(PATH).alias("path")))
    kids = node["children"]
    side = lambda part: F.array_join(F.transform(part, lambda c: c["hash"]), "")

    def below(child: Column, i: Column) -> Column:
        left, right = side(F.slice(kids, F.lit(1), i)), side(F.slice(kids, i + 2, F.lit(FAN)))
        here = F.when(node["hashed"], F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(F.array().cast(PATH))
        return F.transform(emitted(child, height - 1), lambda x: F.struct(x["node"].alias("node"), F.concat(x["path"], here).alias("path")))

    return F.flatten(F.transform(kids, below))


def descend(blocks: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """(tree, node, path, top, root) of the leaves of ``blocks``; ``above(tree, block, path, top, root)``
    has the proof of every block's root."""
    lacking = lambda df, names: [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in names]
    ups = ["path", "top", "root"]
    mine = blocks.select("tree", "block", "node", *lacking(above, ups))
    both = mine.union(above.select("tree", "block", *lacking(blocks, ["node"]), *ups))
    met = both.groupBy("tree", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("node", *ups)])
    return exploded(met, height)


def exploded(met: DataFrame, height: int) -> DataFrame:
    leaves = met.select("tree", F.explode(emitted(F.col("node"), height)).alias("x"), F.col("path").alias("up"), "top", "root")
    return leaves.select("tree", F.col("x.node").alias("node"), F.concat("x.path", "up").alias("path"), "top", "root")


def rounds(nodes: DataFrame, height: int) -> list[tuple[DataFrame, int]]:
    """The blocks of every round with their height, lowest first, for trees of up to ``height``
    levels; the last round has one block a tree."""
    out, done = [], 0
    while not out or done < height:
        step = max(1, min(DIGITS, height - done))
        blocks = materialize(nested(nodes, done, step))
        out.append((blocks, step))
        done += step
        node = F.struct(F.col("node.hash").alias("hash"), F.col("block").alias("at"))
        nodes = blocks.select("tree", "levels", F.col("block").alias("rank"), node.alias("node"))
    return out


def proofs(rows: DataFrame, tree: str, order: list[str], payload: list[str]) -> DataFrame:
    """``payload`` columns, ``hash``, ``path``, ``subroot`` and ``root`` of every row of ``rows``,
    whose leaf digests are in ``hash``. Rows of one ``tree`` make a Merkle tree in ``order``; the
    trees' roots, ascending by ``tree``, make the tree of the root."""
    one = F.lit(1)

    def numbered(df: DataFrame, keys: list[str], by: list[str], name: Column, node: Column) -> DataFrame:
        ranked = running(df, keys, by, [Running("_rank", "count", one), Running("_n", "count", one, whole=True)])
        return ranked.select(name.alias("tree"), levels_of(F.col("_n")).alias("levels"), (F.col("_rank") - 1).alias("rank"), node.alias("node"))

    sizes = rows.groupBy(tree).agg(F.count(one).alias("n"))
    largest, count = sizes.agg(F.max(levels_of(F.col("n"))), levels_of(F.count(one))).first()
    trees = rounds(numbered(rows, [tree], order, F.col(tree), F.struct("hash", *payload)), largest or 0)
    tops = trees[-1][0].select(F.col("tree").alias("at"), F.col("node.hash").alias("hash"))
    whole = rounds(numbered(tops, [], ["at"], F.lit(0), F.struct("hash", "at")), count)

    none = F.array().cast(PATH).alias("path")
    blocks, height = whole[-1]
    found = exploded(blocks.select("tree", "node", none, F.lit(None).cast("string").alias("top"), F.col("node.hash").alias("root")), height)
    for blocks, height in whole[-2::-1]:
        found = descend(blocks, found.select("tree", F.col("node.at").alias("block"), "path", "top", "root"), height)
    # a tree's root is the one block of its last round
    above = found.select(F.col("node.at").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.col("node.hash").alias("top"), "root")
    for blocks, height in trees[:0:-1]:
        above = descend(blocks, above, height).select("tree", F.col("node.at").alias("block"), "path", "top", "root")
    blocks, height = trees[0]
    out = descend(blocks, above, height)
    return out.select(*[F.col(f"node.{c}").alias(c) for c in ("hash", *payload)], "path", F.col("top").alias("subroot"), "root")


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(path, digest, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame, tree: str = "lang", key: str = "doc_id", fields=FIELDS, extra: dict[str, Column] | None = None) -> DataFrame:
    """(key, hash, extra..., path, subroot, root) of every row: the dataset's manifest."""
    extra = extra or {}
    columns = [F.col(c) for c in fields]
    rows = docs.select(F.col(key).alias("_key"), F.col(tree).alias("_tree"), leaf(columns).alias("hash"), *[c.alias(n) for n, c in extra.items()])
    out = proofs(rows, "_tree", ["_key", "hash"], ["_key", *extra])
    return out.withColumnRenamed("_key", key)


def query(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("decimal(20,0)")
    tampered = leaf([F.col("doc_id"), F.col("source"), F.col("lang"), chars + 1, F.col("text")])
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    proved = manifest(docs, extra={"given": F.when(hit, tampered)})
    back = folded(F.coalesce("given", "hash"), F.col("path"))
    out = proved.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), back.alias("folded_root")
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
