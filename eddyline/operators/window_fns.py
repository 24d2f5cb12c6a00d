"""Window functions over ``(key, window)`` groups.

Incremental functions (reduce, aggregate, fold with a built-in combiner) are
grouped aggregates with map-side partial aggregation. Full-window functions
(``process``/``apply``) that only need counts or records are also expressed as
aggregates; arbitrary Python window functions go through ``apply_window``
(``applyInPandas`` on the group), which must hold one group in a worker.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.fixed import TUPLE_KEY_FORMAT, WINDOW_COUNT_TEXT_FORMAT, WINDOW_LABEL_FORMAT
from eddyline.functions.text import java_ts_text
from eddyline.operators.groups import map_groups
from eddyline.operators.user_windows import record_reduce
from eddyline.operators.windows import window_agg


def label(win_start: Column | str, key: Column | str, tuple_key: bool = False) -> Column:
    """``new Timestamp(window.getStart()) + ":" + key``; a Tuple key prints ``(key)``."""
    s = F.col(win_start) if isinstance(win_start, str) else win_start
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    if tuple_key:
        k = F.format_string(TUPLE_KEY_FORMAT, k)
    return F.format_string(WINDOW_LABEL_FORMAT, java_ts_text(s), k)


def fold_concat(value: Column | str, order: Column | str, sep: str = "") -> Column:
    """``FoldFunction`` ``acc + value`` from ``""`` in arrival order, as an ordered
    string aggregate."""
    v = F.col(value) if isinstance(value, str) else value
    o = F.col(order) if isinstance(order, str) else order
    items = F.array_sort(F.collect_list(F.struct(o.alias("o"), v.cast("string").alias("v"))))
    return F.array_join(F.transform(items, lambda x: x.getField("v")), sep)


def window_count_text(window_text: Column, count: Column) -> Column:
    """``"Window: " + window + "count: " + n`` (``fixed.WINDOW_COUNT_TEXT_FORMAT``)."""
    return F.format_string(WINDOW_COUNT_TEXT_FORMAT, window_text, count.cast("string"))


def fold_concat_by(df: DataFrame, keys: list[str], order: str, value: str, sep: str = "", name: str = "folded") -> DataFrame:
    """Grouped string fold that stays parallel on a hot group: rows get the
    prefix scan's buckets (ranges of ``order``), each ``(group, bucket)`` is
    sorted and concatenated on its own, then the at most ``nk`` pieces of a group
    are joined in bucket order. Concatenation is associative, so the result
    equals the fold over the whole group."""
    from eddyline.operators.prefix import assign_buckets

    b = assign_buckets(df.select(*keys, order, value), keys, [order])
    parts = b.df.groupBy(*keys, "_b").agg(fold_concat(value, order, sep).alias("_part"))
    pieces = F.array_sort(F.collect_list(F.struct(F.col("_b"), F.col("_part"))))
    return parts.groupBy(*keys).agg(F.array_join(F.transform(pieces, lambda x: x.getField("_part")), sep).alias(name))


def check_fold_allowed(win: Column) -> None:
    """Fold needs a fixed element order and cannot merge; the library forbids it
    on merging (session) windows, and so does this one."""
    if "session_window" in str(win):
        raise ValueError("fold is not supported on merging (session) windows")


def window_fold(
    df: DataFrame,
    keys: list[str],
    win: Column,
    order: str,
    zero: Column,
    step: Callable[[Column, Column], Column],
    fields: list[str],
    name: str = "folded",
    finish: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``FoldFunction``: ``step(acc, element)`` from ``zero`` over a window's elements in
    ``order``, as column expressions (``element`` has ``fields``). A fold is sequential: the
    elements of one window are gathered in one array, so a window must fit a task (string
    concatenation can be cut, see ``fold_concat_by``). ``(keys..., win_start, win_end, name)``."""
    check_fold_allowed(win)
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_order"), *[F.col(f) for f in fields])))
    folded = F.aggregate(F.col("_rows"), zero, step, finish) if finish else F.aggregate(F.col("_rows"), zero, step)
    grouped = window_agg(df, keys, win, rows.alias("_rows"))
    return grouped.select(*keys, "win_start", "win_end", folded.alias(name))


def window_fold_composed(
    df: DataFrame,
    keys: list[str],
    win: Column,
    order: str,
    lift: Callable[[Column], Column],
    combine: Callable[[Column, Column], Column],
    finish: Callable[[Column], Column],
    fields: list[str],
    name: str = "folded",
    hot_rows: float | None = None,
) -> DataFrame:
    """A fold whose steps compose, in parallel: ``lift(element)`` is an element's step as a value,
    ``combine(f, g)`` the step that does ``f``, then ``g`` (associative), ``finish`` applies the whole
    step to the fold's start. Each (window, bucket) is folded on its own (buckets are ranges of ``order``
    in windows that hold more than a task's share of the rows), then the at most P buckets of
    a window. ``(keys..., win_start, win_end, name)``."""
    from eddyline.operators.prefix import assign_buckets

    check_fold_allowed(win)
    rows = df.select(*keys, order, *[f for f in fields if f != order], win.alias("_w"))
    rows = rows.select("*", F.col("_w.start").alias("win_start"), F.col("_w.end").alias("win_end")).drop("_w")
    group = [*keys, "win_start", "win_end"]
    b = assign_buckets(rows, group, [order], hot_rows)

    def folded(items: Column) -> Column:
        return F.aggregate(F.slice(items, 2, F.size(items)), items[0], lambda acc, x: combine(acc, x))

    element = F.struct(*fields)
    steps = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), lift(element).alias("s"))))
    parts = b.df.groupBy(*group, "_b").agg(folded(F.transform(steps, lambda x: x["s"])).alias("_step"))
    pieces = F.array_sort(F.collect_list(F.struct("_b", "_step")))
    out = parts.groupBy(*group).agg(folded(F.transform(pieces, lambda x: x["_step"])).alias("_step"))
    return out.select(*group, finish(F.col("_step")).alias(name))


def window_reduce(
    df: DataFrame,
    keys: list[str],
    ts: str,
    win: Callable[[str], Column] | None,
    fields: list[str],
    reducer: Callable[[dict, dict], dict],
    gap: str | Column | None = None,
    **more,
) -> DataFrame:
    """``ReduceFunction`` per window with an arbitrary Python reducer over records of ``fields``
    (two phases: per task, then merged; it must be associative and commutative), on tables and
    streams. ``win`` maps the time column to a fixed window; ``gap`` asks for session windows.
    ``(keys..., win_start, win_end, fields...)``; see ``user_windows.record_reduce``."""
    return record_reduce(df, keys, ts, fields, reducer, win=win, gap=gap, **more)


def min_record(value: str, order: str, record: tuple[str, ...]) -> Column:
    """``reduce((a, b) -> a.value <= b.value ? a : b)``: the minimum record, ties keep
    the earlier one."""
    return F.min(F.struct(F.col(value).alias("_v"), F.col(order).alias("_o"), *[F.col(c) for c in record]))


def smaller_record(value: str, order: str) -> Callable[[dict, dict], dict]:
    """``min_record`` as a Python reducer."""

    def f(a: dict, b: dict) -> dict:
        return a if (a[value], a[order]) <= (b[value], b[order]) else b

    return f


def java_ts_text_py(ts: pd.Timestamp) -> str:
    """``Timestamp.toString`` in Python (fraction trimmed, at least one digit)."""
    frac = f"{ts.microsecond:06d}".rstrip("0") or "0"
    return f"{ts:%Y-%m-%d %H:%M:%S}.{frac}"


def count_label_process(key_col: str) -> Callable[[pd.DataFrame], dict]:
    """The reference's ProcessWindowFunction: all elements of a window ->
    ``(start:key, number of elements)``."""

    def fn(pdf: pd.DataFrame) -> dict:
        label = WINDOW_LABEL_FORMAT % (java_ts_text_py(pd.Timestamp(pdf["win_start"].iloc[0])), pdf[key_col].iloc[0])
        return {"label": label, "cnt": len(pdf)}

    return fn


def apply_window(
    df: DataFrame,
    keys: list[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    order: list[str] | None = None,
) -> DataFrame:
    """General ``ProcessWindowFunction``: ``fn`` gets all rows of one
    ``(keys..., win_start, win_end)`` group as a pandas frame (sorted by
    ``order``). Use only when no aggregate expresses the function: one group
    must fit one worker."""
    return map_groups(df, [*keys, "win_start", "win_end"], fn, schema, order)


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
