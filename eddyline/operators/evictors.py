"""Evictors on keyed time windows: remove elements before the window function runs.

Window contents are never gathered into one list: count eviction ranks rows
from the end with the hot-key-safe prefix scan; time and delta eviction put the group's
maximum / last element beside each row with the same scan, so the source is read and
shuffled once and a hot window is cut into ranges that are scanned in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.prefix import Running, row_number, running


def evict_count(df: DataFrame, keys: list[str], order: str, keep: int, hot_rows=None) -> DataFrame:
    """``CountEvictor.of(n)``: keep the last ``n`` elements (by ``order``) per group."""
    rev = df.withColumn("_neg", -F.col(order))
    ranked = row_number(rev, keys, ["_neg"], "_rrn", hot_rows=hot_rows)
    return ranked.filter(F.col("_rrn") <= keep).drop("_neg", "_rrn")


def evict_time(df: DataFrame, keys: list[str], ts: str, interval: str, hot_rows=None) -> DataFrame:
    """``TimeEvictor.of(interval)``: cutoff = max timestamp in the window - interval;
    elements at or before the cutoff are removed."""
    latest = Running("_mx", "max", F.col(ts), whole=True)
    j = running(df, keys, [ts], [latest], hot_rows=hot_rows)
    return j.filter(F.col(ts) > F.col("_mx") - F.expr(f"INTERVAL {interval}")).drop("_mx")


def evict_delta(df: DataFrame, keys: list[str], order: str, value: str, delta, threshold: float, hot_rows=None) -> DataFrame:
    """``DeltaEvictor.of(threshold, delta)``: elements whose ``delta(last, x)`` to the
    window's last element is ``>= threshold`` are removed. ``delta`` maps two
    Columns (last, x) to a numeric Column."""
    j = running(df, keys, [order], [Running("_last", "last", F.col(value), whole=True)], hot_rows=hot_rows)
    return j.filter(~(delta(F.col("_last"), F.col(value)) >= F.lit(threshold))).drop("_last")


def evict_where(df: DataFrame, keep: Column) -> DataFrame:
    """Custom ``evictBefore``: a predicate on each element (and any columns the
    caller joined in) that says which elements stay."""
    return df.filter(keep)
