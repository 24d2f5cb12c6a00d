"""User aggregate and reduce functions over windows: one class for tables and streams.

Fixed windows (tumbling, sliding, with offsets) and session windows take any
``AggregateFunction``. On a bounded table the function runs in two phases (per-task
accumulators, merged by key and window); sessions are found first with the prefix scans of
``windows.session_rows``, so neither a hot key nor a hot session meets in one task whole. On a
stream the accumulators live in the state store (``streaming.aggregate``).

A stream needs a watermark on ``ts``; a window is emitted when the watermark passes its end. With
``updates=True`` the rows of every change are emitted instead, with ``retracted`` true for sessions
that were merged away; ``last_updates`` turns them into the windows as they are at the end of the
input, which is what the batch form returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.operators.udaf import AggregateFunction, ReduceFunction, aggregate
from eddyline.operators.windows import gap_interval, session_rows

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros(df: DataFrame, column: Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without a zone."""
    ntz = isinstance(df.select(column).schema[0].dataType, T.TimestampNTZType)
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), column) if ntz else F.unix_micros(column)


def from_micros(us: Column, dt: T.DataType) -> Column:
    return F.timestamp_add("MICROSECOND", us, F.expr(EPOCH)) if isinstance(dt, T.TimestampNTZType) else F.timestamp_micros(us)


class _Spanned(AggregateFunction):
    """A session's span beside the user's accumulator."""

    skip_nulls = False

    def __init__(self, fn: AggregateFunction):
        self.fn = fn

    def create_accumulator(self):
        return None, None, self.fn.create_accumulator()

    def add(self, value, acc):
        start, end, inner = acc
        v = value["v"]
        inner = inner if v is None and self.fn.skip_nulls else self.fn.add(v, inner)
        return (value["s"], value["e"], inner) if start is None else (min(start, value["s"]), max(end, value["e"]), inner)

    def merge(self, a, b):
        if a[0] is None or b[0] is None:
            return b if a[0] is None else a
        return min(a[0], b[0]), max(a[1], b[1]), self.fn.merge(a[2], b[2])

    def get_result(self, acc):
        return {"s": acc[0], "e": acc[1], "r": self.fn.get_result(acc[2])}


def window_aggregate(
    df: DataFrame,
    keys: list[str],
    ts: str,
    win: Callable[[str], Column],
    value: str | Column,
    fn: AggregateFunction,
    result_type: str = "double",
    result_name: str = "result",
    updates: bool = False,
) -> DataFrame:
    """``(keys..., win_start, win_end, result)`` of ``fn`` over fixed windows; ``win`` maps the time
    column to a window (``windows.tumbling`` or ``sliding`` with its parameters)."""
    window = win(ts)
    if "session_window" in str(window):
        raise ValueError("session windows merge: use session_aggregate with the gap")
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(*keys, window.alias("_w"), v.alias("_value"))
    if df.isStreaming:
        rows = rows.select(*keys, "_w.start", "_w.end", "_value")
        return _on_stream(rows, keys, fn, result_type, result_name, False, updates)
    rows = rows.select(*keys, F.col("_w.start").alias("win_start"), F.col("_w.end").alias("win_end"), "_value")
    return aggregate(rows, [*keys, "win_start", "win_end"], "_value", fn, result_type, result_name)


def session_aggregate(
    df: DataFrame,
    keys: list[str],
    ts: str,
    gap: str | Column,
    value: str | Column,
    fn: AggregateFunction,
    result_type: str = "double",
    result_name: str = "result",
    order: str | None = None,
    updates: bool = False,
    hot_rows: float | None = None,
) -> DataFrame:
    """``(keys..., win_start, win_end, result)`` of ``fn`` over session windows of ``gap`` (an interval
    string, or a Column of them for a gap by element). Accumulators of parts of a session are
    merged, so ``merge`` must not depend on the order. Rows without a time are in no session."""
    v = F.col(value) if isinstance(value, str) else value
    df = df.where(F.col(ts).isNotNull())
    if df.isStreaming:
        rows = df.select(*keys, F.col(ts).alias("start"), (F.col(ts) + gap_interval(gap)).alias("end"), v.alias("_value"))
        return _on_stream(rows, keys, fn, result_type, result_name, True, updates)
    rows = session_rows(df.withColumn("_value", v), keys, ts, gap, order, hot_rows)
    dt = df.schema[ts].dataType
    spanned = F.struct(micros(rows, F.col(ts)).alias("s"), micros(rows, F.col("_end")).alias("e"), F.col("_value").alias("v"))
    rows = rows.select(*keys, "_sstart", spanned.alias("_rec"))
    out = aggregate(rows, [*keys, "_sstart"], "_rec", _Spanned(fn), f"struct<s:bigint,e:bigint,r:{result_type}>", "_out")
    times = [from_micros(F.col(f"_out.{x}"), dt).alias(name) for x, name in (("s", "win_start"), ("e", "win_end"))]
    return out.select(*keys, *times, F.col("_out.r").alias(result_name))


def _on_stream(rows, keys, fn, result_type, result_name, merging, updates) -> DataFrame:
    """``rows(keys, start, end, _value)`` through the accumulators of the state store."""
    from eddyline.streaming.aggregate import AggregateWindowProcessor
    from eddyline.streaming.stateful import use_rocksdb

    use_rocksdb(rows.sparkSession)
    if not keys:
        raise ValueError("a stream is aggregated by key: give a key column")
    dt = rows.schema["start"].dataType
    given = rows.select(*keys, micros(rows, F.col("start")).alias("_start"), micros(rows, F.col("end")).alias("_end"), "_value")
    schema = T.StructType([rows.schema[k] for k in keys])
    schema = schema.add("_start", "long").add("_end", "long")
    schema = T.StructType([*schema.fields, *T.StructType.fromDDL(f"_result {result_type}").fields]).add("_gone", "boolean")
    processor = AggregateWindowProcessor(fn, keys, merging, updates)
    out = given.groupBy(*keys).transformWithState(processor, schema, "Update" if updates else "Append", "EventTime")
    times = [from_micros(F.col(c), dt).alias(name) for c, name in (("_start", "win_start"), ("_end", "win_end"))]
    return out.select(*keys, *times, F.col("_result").alias(result_name), *([F.col("_gone").alias("retracted")] if updates else []))


def processing_sessions(
    df: DataFrame, keys: list[str], gap: str | Column, value: str | Column, fn: AggregateFunction,
    result_type: str = "double", result_name: str = "result",
) -> DataFrame:
    """``(keys..., win_start, win_end, result)`` over sessions by the time at which a stream's rows are
    handled (``ProcessingTimeSessionWindows``), also across micro-batches. ``gap``: an interval string,
    or a Column of day-time intervals. Such a query runs until it is stopped, as its timers may."""
    from eddyline.streaming.aggregate import ProcessingSessionProcessor
    from eddyline.streaming.stateful import use_rocksdb

    if not df.isStreaming:
        raise ValueError("a table has no processing time: use session_aggregate on a time column")
    use_rocksdb(df.sparkSession)
    v = F.col(value) if isinstance(value, str) else value
    from_zero = F.expr("TIMESTAMP_SECONDS(0)") + gap_interval(gap)
    rows = df.select(*keys, F.unix_millis(from_zero).alias("_gap"), v.alias("_value"))
    tail = T.StructType.fromDDL(f"_start long, _end long, _result {result_type}").fields
    schema = T.StructType([*(df.schema[k] for k in keys), *tail])
    out = rows.groupBy(*keys).transformWithState(ProcessingSessionProcessor(fn, keys), schema, "Update", "ProcessingTime")
    times = [F.timestamp_micros(c).alias(name) for c, name in (("_start", "win_start"), ("_end", "win_end"))]
    return out.select(*keys, *times, F.col("_result").alias(result_name))


def late_windows(
    df: DataFrame, keys: list[str], ts: str, win: Callable[[str], Column], value: str | Column, fn: AggregateFunction,
    bound: str, lateness: str = "0 seconds", result_type: str = "double", result_name: str = "result",
) -> DataFrame:
    """Fixed windows of a stream with allowed lateness and a side output, kept in the state store alone.
    ``(keys..., win_start, win_end, result, firing, side, value)``: firing 0 when the watermark (``bound``
    behind the largest time of the micro-batches before) passes the end, 1, 2, ... for each row
    that is late but allowed; rows later than that have ``side`` true and their own ``value``."""
    from eddyline.operators.windows import duration_us
    from eddyline.streaming.aggregate import LateWindowProcessor
    from eddyline.streaming.stateful import use_rocksdb

    use_rocksdb(df.sparkSession)
    v = F.col(value) if isinstance(value, str) else value
    rows = df.withWatermark(ts, bound).select(*keys, win(ts).alias("_w"), v.alias("_value"))
    rows = rows.select(*keys, "_w.start", "_w.end", "_value")
    dt = rows.schema["start"].dataType
    # without the time column itself, Spark does not drop the rows that it takes for late
    given = rows.select(*keys, micros(rows, F.col("start")).alias("_start"), micros(rows, F.col("end")).alias("_end"), "_value")
    tail = T.StructType.fromDDL(f"_start long, _end long, _result {result_type}, _firing long, _side boolean").fields
    schema = T.StructType([*(rows.schema[k] for k in keys), *tail, T.StructField("_value", rows.schema["_value"].dataType)])
    out = given.groupBy(*keys).transformWithState(LateWindowProcessor(fn, keys, duration_us(lateness)), schema, "Update", "EventTime")
    times = [from_micros(F.col(c), dt).alias(name) for c, name in (("_start", "win_start"), ("_end", "win_end"))]
    named = {"_result": result_name, "_firing": "firing", "_side": "side", "_value": "value"}
    return out.select(*keys, *times, *[F.col(c).alias(n) for c, n in named.items()])


def last_updates(df: DataFrame, keys: list[str], name: str, checkpoint: str | None = None) -> DataFrame:
    """Run a stream of ``updates`` over the data available now and return the windows as they are at
    its end: every open window counts as complete, as in the batch form."""
    from eddyline.streaming.run import run_available

    out = run_available(df, name, checkpoint=checkpoint, flush=[*keys, "win_start", "win_end"])
    return out.where("not retracted").drop("retracted")


def record_reduce(
    df: DataFrame,
    keys: list[str],
    ts: str,
    fields: list[str],
    reducer: Callable[[dict, dict], dict],
    win: Callable[[str], Column] | None = None,
    gap: str | Column | None = None,
    **more,
) -> DataFrame:
    """``ReduceFunction`` over records of ``fields`` per fixed window (``win``) or session (``gap``):
    ``(keys..., win_start, win_end, fields...)``. The reducer must be associative and commutative."""
    if (win is None) == (gap is None):
        raise ValueError("give a window or a gap")
    kind = T.StructType([df.schema[f] for f in fields]).simpleString()
    record = F.struct(*fields)
    fn = ReduceFunction(reducer)
    if win is not None:
        out = window_aggregate(df, keys, ts, win, record, fn, kind, "_rec", **more)
    else:
        out = session_aggregate(df, keys, ts, gap, record, fn, kind, "_rec", **more)
    rest = ["retracted"] if more.get("updates") else []
    return out.select(*keys, "win_start", "win_end", *[F.col(f"_rec.{f}").alias(f) for f in fields], *rest)


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
