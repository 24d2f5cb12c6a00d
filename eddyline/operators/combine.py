"""Combining streams: union of same-typed inputs and connect/co-map of two."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """``a.union(b, c, ...)``: same-typed streams merged, duplicates kept."""
    if not frames:
        raise ValueError("union_all needs at least one input")
    return reduce(lambda a, b: a.unionByName(b), frames)


def connect_comap(
    left: DataFrame,
    right: DataFrame,
    map1: Callable[[DataFrame], Column],
    map2: Callable[[DataFrame], Column],
    keep1: tuple[str, ...] = (),
    keep2: tuple[str, ...] = (),
) -> DataFrame:
    """``left.connect(right).map(map1, map2)``: each side keeps its own type and
    function; the output is one tagged row per input element (not a join).

    ``map1`` must give a string column, ``map2`` an integral one; the result is
    ``(side, str_value, int_value, *keep)``. Keep columns must be named the same
    on both sides when given.
    """
    a = left.select(
        F.lit(1).alias("side"),
        map1(left).cast("string").alias("str_value"),
        F.lit(None).cast("long").alias("int_value"),
        *keep1,
    )
    b = right.select(
        F.lit(2).alias("side"),
        F.lit(None).cast("string").alias("str_value"),
        map2(right).cast("long").alias("int_value"),
        *keep2,
    )
    return a.unionByName(b, allowMissingColumns=True)
