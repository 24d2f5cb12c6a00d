"""User aggregate functions over sliding windows (by time or by count), without copies of rows.

A function that has no inverse cannot drop the element that leaves a window, and copying each row
into the ``size / slide`` windows that hold it multiplies the data. Here the rows of a task are
aggregated per *pane* of ``gcd(size, slide)``, and the accumulators are shuffled once, by key and *stretch*
of ``SPAN`` window lengths; those of a stretch's first window length also go to the stretch before, whose
last windows reach into it. One sorted pass merges the accumulators of each pane and slides over
the panes with a queue that keeps the merges of its older part from each pane on, and one merge of
its newer part: at most three merges a pane and window, whatever the ratio of size to slide.
A key's stretches are dealt to different tasks, so a hot key stays parallel, and a task holds at
most one window's accumulators (``size / gcd``) at a time. ``merge`` must leave its arguments as they are.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from eddyline.operators.prefix import Running, running
from eddyline.operators.udaf import AggregateFunction, key_of, partials, value_of
from eddyline.operators.user_windows import from_micros, micros
from eddyline.operators.windows import duration_us
from eddyline.session import target_parallelism


# window lengths that a stretch, the unit that is dealt to a task, holds
SPAN = 16
BATCH_ROWS = 10_000


def merged_panes(rows: Iterable[tuple[int, bytes]], merge: Callable) -> Iterator[tuple[int, object]]:
    """(pane, accumulator) of pickled accumulators by ascending pane; None is none (a pane of nulls only)."""
    now, acc = None, None
    for pane, raw in rows:
        part = pickle.loads(raw)
        if part is None:
            continue
        if pane == now:
            acc = merge(acc, part)
        else:
            if now is not None:
                yield now, acc
            now, acc = pane, part
    if now is not None:
        yield now, acc


def slide_over(panes: Iterable[tuple[int, object]], lo: int, hi: int, width: int, step: int, shift: int, merge: Callable) -> Iterator[tuple[int, object]]:
    """(first pane, accumulator) of the windows that start in ``lo`` to ``hi - 1`` and have elements; windows
    start at panes equal to ``shift`` modulo ``step`` and are ``width`` panes long. ``panes`` ascend."""
    coming = iter(panes)
    pane, acc = next(coming, (None, None))
    older: list = []  # (pane, merge of it and the later ones in older), the earliest last
    newer: list = []  # (pane, accumulator), after those of older
    newest = None  # merge of newer
    start = lo + (shift - lo) % step
    while start < hi:
        if not older and not newer:
            if pane is None:
                return
            reach = pane - width + 1  # the first window that reaches the next pane
            start = max(start, reach + (shift - reach) % step)
            if start >= hi:
                return
        while pane is not None and pane < start + width:
            if pane >= start:
                newest = merge(newest, acc) if newer else acc
                newer.append((pane, acc))
            pane, acc = next(coming, (None, None))
        while older and older[-1][0] < start:
            older.pop()
        if not older and newer:
            for at, part in reversed(newer):
                if at < start:
                    break
                older.append((at, merge(part, older[-1][1]) if older else part))
            newer, newest = [], None
        if older:
            yield start, merge(older[-1][1], newest) if newer else older[-1][1]
        start += step


def _windows(rows: DataFrame, keys: list[str], width: int, step: int, shift: int, fn: AggregateFunction, result_type: str) -> DataFrame:
    """(keys..., _start, _result) from ``rows(keys..., _pane, _value)``."""
    key_fields = [rows.schema[k] for k in keys]
    result = to_arrow_type(T.StructType.fromDDL(f"r {result_type}")[0].dataType)
    stretch = SPAN * width
    n = len(keys)

    def stretches(key: tuple) -> list[int]:
        own, within = divmod(key[n], stretch)
        # windows that reach the first ``width - 1`` panes of a stretch may start in the one before
        return [own, own - 1] if within < width - 1 else [own]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list = []

        def given_rows():
            for batch in batches:
                types[:] = [batch.schema.field(k).type for k in keys]
                yield from zip(*(batch.column(c).to_pylist() for c in [*keys, "_place", "_pane", "_acc"]))

        out: list[list] = [[] for _ in range(n + 2)]

        def flush():
            arrays = [pa.array(c, t) for c, t in zip(out, [*types, pa.int64(), result])]
            for c in out:
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[*keys, "_start", "_result"])

        for key, run in groupby(given_rows(), lambda row: key_of(row[: n + 1])):
            given, lo = value_of(key[:n]), key[n] * stretch
            panes = merged_panes(((row[n + 1], row[n + 2]) for row in run), fn.merge)
            for start, acc in slide_over(panes, lo, lo + stretch, width, step, shift, fn.merge):
                for column, v in zip(out, (*given, start, fn.get_result(acc))):
                    column.append(v)
                if len(out[n]) >= BATCH_ROWS:
                    yield flush()
        if out[n]:
            yield flush()

    parts = partials(rows, [*keys, "_pane"], "_value", fn, places=stretches)
    parts = parts.repartition(target_parallelism(rows.sparkSession), *keys, "_place").sortWithinPartitions(*keys, "_place", "_pane")
    return parts.mapInArrow(joined, T.StructType([*key_fields, *T.StructType.fromDDL(f"_start long, _result {result_type}").fields]))


def sliding_aggregate(
    df: DataFrame, keys: list[str], ts: str, size: str, slide: str, value: str | Column, fn: AggregateFunction,
    result_type: str = "double", result_name: str = "result", offset: str | None = None,
) -> DataFrame:
    """``(keys..., win_start, win_end, result)`` of any aggregate function over sliding event-time
    windows of a bounded table. Rows without a time are in no window; streams: ``window_aggregate``."""
    if df.isStreaming:
        raise ValueError("sliding_aggregate is the batch form; on a stream use user_windows.window_aggregate")
    long, hop = duration_us(size), duration_us(slide)
    pane, off = math.gcd(long, hop), duration_us(offset or "0 seconds") % hop
    v = F.col(value) if isinstance(value, str) else value
    at = F.floor((micros(df, F.col(ts)) - F.lit(off)) / F.lit(pane)).cast("long")
    rows = df.where(F.col(ts).isNotNull()).select(*keys, at.alias("_pane"), v.alias("_value"))
    out = _windows(rows, keys, long // pane, hop // pane, 0, fn, result_type)
    start = F.col("_start") * F.lit(pane) + F.lit(off)
    dt = df.schema[ts].dataType
    times = [from_micros(start, dt).alias("win_start"), from_micros(start + F.lit(long), dt).alias("win_end")]
    return out.select(*keys, *times, F.col("_result").alias(result_name))


def count_sliding_aggregate(
    df: DataFrame, keys: list[str], order: list[str], size: int, slide: int, value: str | Column, fn: AggregateFunction,
    result_type: str = "double", result_name: str = "result", hot_rows: float | None = None,
) -> DataFrame:
    """``countWindow(size, slide)`` with any aggregate function on a bounded table: every ``slide``-th
    element of a key fires over its last ``size`` elements (fewer at the beginning).
    ``(keys..., fire, n_elems, result)``, ``fire`` = 1, 2, ... per key."""
    pane = math.gcd(size, slide)
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(*keys, *[c for c in order if c not in keys], v.alias("_value"))
    one = F.lit(1)
    rows = running(rows, keys, order, [Running("_rn", "count", one), Running("_n", "count", one, whole=True)], hot_rows=hot_rows)
    rows = rows.select(*keys, "_n", F.floor((F.col("_rn") - 1) / pane).cast("long").alias("_pane"), "_value")
    with_n = [*keys, "_n"]
    width, step = size // pane, slide // pane
    out = _windows(rows, with_n, width, step, -width % step, fn, result_type)
    end = (F.col("_start") + width) * pane  # elements up to the firing one
    out = out.where((end > 0) & (end <= F.col("_n")))
    return out.select(*keys, F.floor(end / slide).cast("long").alias("fire"), F.least(end, F.lit(size)).cast("long").alias("n_elems"), F.col("_result").alias(result_name))


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
