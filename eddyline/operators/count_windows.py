"""Count windows, global windows and count triggers (batch form).

Each row gets its global position ``rn`` inside its key from ``prefix.row_number``
(hot keys split), after which every count window is a grouped aggregate over a
computed window id: no single-task ordering of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.prefix import Running, row_number, running


def stream_count_window(df: DataFrame, key: str, order: str, value: str, size: int, slide: int | None = None) -> DataFrame:
    """Count windows on a stream: a ``transformWithState`` buffer of at most
    ``size`` elements per key. Output ``(key, fire_seq, n_elems, sum_value)``."""
    from pyspark.sql import types as T

    from eddyline.streaming.stateful import CountWindowProcessor, use_rocksdb

    use_rocksdb(df.sparkSession)
    out = T.StructType(
        [
            T.StructField(key, df.schema[key].dataType),
            T.StructField("fire_seq", T.LongType()),
            T.StructField("n_elems", T.LongType()),
            T.StructField("sum_value", T.DoubleType()),
        ]
    )
    proc = CountWindowProcessor(size, slide, value=value, order=order, emit_key=True)
    res = df.groupBy(key).transformWithState(proc, out, "Update", "None")
    return res


def count_tumbling(df: DataFrame, key: str, order: str, size: int, *aggs: Column, hot_rows=None) -> DataFrame:
    """``countWindow(size)``: fires on every ``size``-th element of a key with those
    ``size`` elements; an incomplete last window never fires. (Streams: see
    ``stream_count_window``.)"""
    if df.isStreaming:
        raise ValueError("count windows on a stream: use stream_count_window (state store buffer)")
    ranked = row_number(df, [key], [order], "_rn", hot_rows=hot_rows)
    grouped = ranked.groupBy(key, F.floor((F.col("_rn") - 1) / size).alias("win_idx")).agg(
        F.count(F.lit(1)).alias("_n"), F.max(order).alias("fire_seq"), *aggs
    )
    return grouped.filter(F.col("_n") == size).drop("_n")


def count_sliding(
    df: DataFrame, key: str, order: str, size: int, slide: int, value: str, hot_rows=None
) -> DataFrame:
    """``countWindow(size, slide)``: fires on every ``slide``-th element of a key
    over the last (up to) ``size`` elements, so the first firings are partial.

    Each row is sent to the firings that include it (positions ``rn .. rn+size-1``
    that are multiples of ``slide``: at most ``ceil(size/slide)`` copies), then
    summed per ``(key, firing)``. A firing exists only if its own element does.
    """
    if df.isStreaming:
        return stream_count_window(df, key, order, value, size, slide)
    ranked = row_number(df, [key], [order], "_rn", hot_rows=hot_rows)
    # multiples of slide in [rn, rn + size - 1], as a stepped sequence (no lambda)
    first = F.ceil(F.col("_rn") / F.lit(slide)).cast("long") * F.lit(slide)
    last = F.col("_rn") + F.lit(size - 1)
    empty = F.array().cast("array<bigint>")
    targets = F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("long"))).otherwise(empty)
    spread = ranked.select(key, F.col(value).alias("_v"), F.col("_rn"), F.explode(targets).alias("fire_rn"))
    agg = spread.groupBy(key, "fire_rn").agg(
        F.sum("_v").alias("sum_vc"),
        F.count(F.lit(1)).alias("n_elems"),
        F.max((F.col("_rn") == F.col("fire_rn")).cast("int")).alias("_own"),
    )
    return agg.filter(F.col("_own") == 1).drop("_own")


def global_count_trigger(
    df: DataFrame, key: str, order: str, every: int, value: str, purge: bool = False, hot_rows=None
) -> DataFrame:
    """``window(GlobalWindows.create()).trigger(CountTrigger.of(n))``: fires on
    every ``n``-th element with the whole window so far. With
    ``PurgingTrigger`` the contents are cleared after each firing, which is
    ``count_tumbling``. With no trigger a global window never fires: see
    ``global_no_trigger``."""
    if purge:
        return count_tumbling(df, key, order, every, F.sum(value).alias("sum_vc"), hot_rows=hot_rows).select(
            key, "fire_seq", "sum_vc"
        )
    specs = [Running("_rn", "count", F.lit(1)), Running("sum_vc", "sum", F.col(value))]
    out = running(df.select(key, order, value), [key], [order], specs, hot_rows=hot_rows)
    return out.filter(F.col("_rn") % every == 0).select(key, F.col(order).alias("fire_seq"), "sum_vc")


def global_no_trigger(df: DataFrame, key: str) -> DataFrame:
    """A global window without a trigger never fires: the result is empty."""
    return df.select(key).where(F.lit(False))
