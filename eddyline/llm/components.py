"""Connected components of a link table, by alternating star contraction.

Each round replaces the links by stars (large-star: a node's larger neighbours point to the
smallest node around it; small-star: its smaller ones do) until nothing changes; the number
of rounds grows with the logarithm of the longest path. Every step is a grouped minimum with
partial aggregation and a join that may be split when skewed, so a component of any size is
never gathered in one task; each round is cut off by a checkpoint in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.session import materialize


def _state(links: DataFrame) -> tuple[int, int]:
    digest = F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))
    return tuple(links.agg(F.count(F.lit(1)), digest).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the smallest node reachable.

    Self links and repeated links are allowed; rows with a null end are ignored; no links
    give no rows.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    edges = materialize(links.where("a is not null and b is not null").select(*ends).where("a <> b").distinct())
    before, now = None, _state(edges)
    while now != before and now[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("x"), F.col("a").alias("y"), "m")
        small = small.select(F.inline(F.array(
            F.struct(F.col("x").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("y").alias("a"), F.col("m").alias("b")),
        )))
        edges = materialize(small.where("a <> b").distinct())
        before, now = now, _state(edges)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
