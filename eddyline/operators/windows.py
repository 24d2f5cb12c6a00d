"""Window assigners: tumbling, sliding, session (static or per-element gap),
non-keyed windows and window metadata.

Event-time windows are Spark's ``window``/``session_window`` expressions; the
grouped aggregate over ``(key, window)`` is a partial + final hash aggregate.
Windows are epoch aligned like the reference's (start = ts - (ts - offset) mod size).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.fixed import WINDOW_TEXT_FORMAT

_UNITS_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


@dataclass(frozen=True)
class Pane:
    """An aggregate that can be put together from parts: ``kind`` is sum, count, max or min."""

    name: str
    kind: str
    value: Column | str

    def col(self) -> Column:
        return F.col(self.value) if isinstance(self.value, str) else self.value


def duration_us(text: str) -> int:
    """``'5 seconds'``, ``'-8 hours'``, ``'1 day 2 hours'`` -> microseconds."""
    total = 0
    parts = re.findall(r"([+-]?\d+)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"not a duration: {text!r}")
    for n, unit in parts:
        u = unit.lower().rstrip("s")
        if u not in _UNITS_US:
            raise ValueError(f"unknown unit {unit!r} in {text!r}")
        total += int(n) * _UNITS_US[u]
    return total


def _us(n: int) -> str:
    return f"{n} microseconds"


def tumbling(ts: Column | str, size: str, offset: str | None = None) -> Column:
    """``TumblingEventTimeWindows.of(size[, offset])``: a negative offset is fine."""
    if offset is None:
        return F.window(ts, size)
    return F.window(ts, size, size, _us(duration_us(offset) % duration_us(size)))


def sliding(ts: Column | str, size: str, slide: str, offset: str | None = None) -> Column:
    """``SlidingEventTimeWindows.of(size, slide[, offset])``. Spark wants
    ``|offset| < slide``; windows repeat every slide, so ``offset mod slide``
    gives the same windows (``12 h, 1 h, -8 h`` -> offset 0)."""
    if offset is None:
        return F.window(ts, size, slide)
    return F.window(ts, size, slide, _us(duration_us(offset) % duration_us(slide)))


def with_processing_time(df: DataFrame, name: str = "proc_ts") -> DataFrame:
    """The time at which a row is handled: on a stream, of its micro-batch."""
    return df.withColumn(name, F.current_timestamp())


def tumbling_processing(size: str, offset: str | None = None, ts: str = "proc_ts") -> Column:
    """``TumblingProcessingTimeWindows.of(size[, offset])`` over ``with_processing_time(df)``."""
    return tumbling(ts, size, offset)


def sliding_processing(size: str, slide: str, offset: str | None = None, ts: str = "proc_ts") -> Column:
    """``SlidingProcessingTimeWindows.of(size, slide[, offset])``."""
    return sliding(ts, size, slide, offset)


def session_processing(gap: str | Column, ts: str = "proc_ts") -> Column:
    """``ProcessingTimeSessionWindows.withGap(gap)`` / ``withDynamicGap``. On a stream the rows
    of a key that fall into one session may come in different micro-batches."""
    return session(ts, gap)


def sliding_agg(
    df: DataFrame, keys: list[str], ts: str, size: str, slide: str, aggs: list[Pane], offset: str | None = None
) -> DataFrame:
    """Sliding windows through panes: rows are aggregated once per pane of ``gcd(size, slide)``,
    and only the panes' rows are copied into the ``size / slide`` windows that hold them.
    ``(keys..., win_start, win_end, aggs...)``; on a stream, plain sliding windows."""
    single = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
    if df.isStreaming:
        return window_agg(df, keys, sliding(ts, size, slide, offset), *[single[a.kind](a.col()).alias(a.name) for a in aggs])
    pane = math.gcd(duration_us(size), duration_us(slide))
    shift = _us(duration_us(offset or "0 seconds") % pane)
    panes = df.groupBy(*keys, F.window(ts, _us(pane), _us(pane), shift).start.alias("_pane")).agg(
        *[single[a.kind](a.col()).alias(a.name) for a in aggs]
    )
    combine = {**single, "count": F.sum}
    return window_agg(panes, keys, sliding("_pane", size, slide, offset), *[combine[a.kind](a.name).alias(a.name) for a in aggs])


def session(ts: Column | str, gap: str | Column) -> Column:
    """``EventTimeSessionWindows.withGap(gap)`` or, with a Column of interval
    strings, ``withDynamicGap``. Rows whose distance equals the gap share a session."""
    return F.session_window(ts, gap)


def session_windows(
    df: DataFrame,
    keys: list[str],
    ts: str,
    gap: str | Column,
    *aggs: Column,
    order: str | None = None,
    hot_rows: float | None = None,
) -> DataFrame:
    """Keyed session windows as ``(keys..., win_start, win_end, aggs...)``.

    Batch: a row starts a session when its ``ts`` is after the running maximum of
    ``ts + gap`` over the key's earlier rows (equal merges); the session of a row is
    the latest start at or before it. Both are ordered prefix scans that split hot
    keys (the second reuses the first one's partitioning), then a grouped aggregate
    with partial aggregation. Spark's ``session_window`` would sort and merge each
    key in one task. Streams use ``session_window`` (state store).
    ``gap``: an interval string, or a Column of interval strings (dynamic gap).
    """
    if df.isStreaming:
        return window_agg(df, keys, session(ts, gap), *aggs)
    rows = session_rows(df, keys, ts, gap, order, hot_rows)
    out = rows.groupBy(*keys, "_sstart").agg(F.min(ts).alias("win_start"), F.max("_end").alias("win_end"), *aggs)
    return out.drop("_sstart")


def gap_interval(gap: str | Column) -> Column:
    return F.expr(f"INTERVAL {duration_us(gap)} MICROSECONDS") if isinstance(gap, str) else gap.cast("interval")


def session_rows(
    df: DataFrame, keys: list[str], ts: str, gap: str | Column, order: str | None = None, hot_rows: float | None = None
) -> DataFrame:
    """The rows of a bounded table with ``_sstart`` (the start of the row's session, which names it
    within the key) and ``_end`` (``ts + gap``)."""
    from eddyline.operators.prefix import Buckets, Running, assign_buckets, running

    order_cols = [ts] + ([order] if order else [])
    work = df.withColumn("_end", F.col(ts) + gap_interval(gap))
    b = assign_buckets(work, keys, order_cols, hot_rows)
    r1 = running(None, keys, order_cols, [Running("_pend", "max", F.col("_end"))], inclusive=False, keep_buckets=True, buckets=b)
    starts = F.when(F.col("_pend").isNull() | (F.col(ts) > F.col("_pend")), F.col(ts))
    b2 = Buckets(r1.withColumn("_fts", starts), b.keys, b.any_hot, dealt=True)
    r2 = running(None, keys, order_cols, [Running("_sstart", "max", F.col("_fts"))], buckets=b2)
    return r2.drop("_pend", "_fts")


def flatten_window(df: DataFrame, col: str = "window") -> DataFrame:
    """``window`` struct -> ``win_start``, ``win_end`` columns (same order otherwise)."""
    cols = []
    for c in df.columns:
        if c == col:
            cols += [F.col(f"{col}.start").alias("win_start"), F.col(f"{col}.end").alias("win_end")]
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def window_agg(df: DataFrame, keys: list[str], win: Column, *aggs: Column) -> DataFrame:
    """Keyed windowed aggregate; ``keys=[]`` is ``windowAll`` (still parallel:
    partial aggregation per task, one final row per window)."""
    return flatten_window(df.groupBy(*keys, win.alias("window")).agg(*aggs))


def max_timestamp(win_end: Column | str) -> Column:
    """``TimeWindow.maxTimestamp()``: the last millisecond inside the window."""
    c = F.col(win_end) if isinstance(win_end, str) else win_end
    return c - F.expr("INTERVAL 1 MILLISECOND")


def window_text(win_start: Column | str, win_end: Column | str) -> Column:
    """``TimeWindow.toString`` (``fixed.WINDOW_TEXT_FORMAT``, epoch milliseconds)."""

    def ms(c):
        if not isinstance(c, str):
            raise TypeError("pass column names")
        # a timestamp with time zone is an instant, one without is read as UTC
        plain = f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(`{c}` AS timestamp_ntz))"
        return F.expr(f"if(typeof(`{c}`) = 'timestamp', unix_millis(cast(`{c}` AS timestamp)), {plain})").cast("string")

    return F.format_string(WINDOW_TEXT_FORMAT, ms(win_start), ms(win_end))
