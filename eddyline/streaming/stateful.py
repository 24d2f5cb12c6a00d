"""Stateful processors for ``groupBy(key).transformWithState``.

Each key's state lives in the state store (RocksDB provider), is checkpointed with
the query and is bounded per key: a rolling value holds one record, a count window
at most ``size`` elements, a triggered time window one partial aggregate per open
window. Inside a micro-batch the rows of a key are processed in ``order``.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)
from pyspark.sql.types import StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Reducer = Callable[[dict, dict], dict]


# ---------------------------------------------------------------- reducers (A2-A5)


def sum_reducer(field: str) -> Reducer:
    """``sum(field)``: other fields stay those of the first record."""

    def f(acc: dict, row: dict) -> dict:
        out = dict(acc)
        if row[field] is not None:  # SQL's sum: nulls do not count, only nulls give null
            out[field] = row[field] if acc[field] is None else acc[field] + row[field]
        return out

    return f


def _rank(v) -> tuple:
    """Order of values as SQL sees it: null below everything, NaN above all numbers."""
    if v is None:
        return (0, 0)
    return (2, 0) if v != v else (1, v)


def max_reducer(field: str) -> Reducer:
    """``max(field)``: only the field advances."""

    def f(acc: dict, row: dict) -> dict:
        out = dict(acc)
        if _rank(row[field]) > _rank(acc[field]):
            out[field] = row[field]
        return out

    return f


def max_by_reducer(field: str, first: bool = False) -> Reducer:
    """``maxBy(field, first)``: the record of the maximum; ties keep the earlier
    record when ``first`` else take the newer one."""

    def f(acc: dict, row: dict) -> dict:
        new, old = _rank(row[field]), _rank(acc[field])
        if new > old or (new == old and not first):
            return dict(row)
        return acc

    return f


def latest_max_reducer(field: str, latest: tuple[str, ...]) -> Reducer:
    """The reference's reducer: latest fields from the new record, max of ``field``."""

    def f(acc: dict, row: dict) -> dict:
        out = dict(acc)
        for c in latest:
            out[c] = row[c]
        out[field] = max(acc[field], row[field], key=_rank)
        return out

    return f


class RollingProcessor(StatefulProcessor):
    """One output row per input row: the key's accumulated record so far.

    ``fields`` are the record's columns (the output schema is ``order`` + fields);
    ``reducer(acc, row)`` folds the next record into the accumulator.
    """

    def __init__(self, fields: list[str], state_schema: StructType, reducer: Reducer, order: str = "seq"):
        self.fields = fields
        self.state_schema = state_schema
        self.reducer = reducer
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", self.state_schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        acc = self.acc.get() if self.acc.exists() else None
        acc = dict(zip(self.fields, acc)) if acc is not None else None
        for r in sorted(rows, key=lambda x: x[self.order]):
            rec = {c: r[c] for c in self.fields}
            acc = rec if acc is None else self.reducer(acc, rec)
            yield Row(**{self.order: r[self.order]}, **acc)
        if acc is not None:
            self.acc.update(tuple(acc[c] for c in self.fields))

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- count windows


class CountWindowProcessor(StatefulProcessor):
    """``countWindow(size[, slide])`` on a stream.

    Tumbling (no slide): buffer elements, fire with ``size`` of them, clear.
    Sliding: keep the last ``size`` elements, fire on every ``slide``-th one.
    Output: (fire_seq, n_elems, sum_value). State per key is at most ``size`` rows.
    """

    def __init__(self, size: int, slide: int | None = None, value: str = "value", order: str = "seq", emit_key: bool = False):
        self.size, self.slide, self.value, self.order, self.emit_key = size, slide, value, order, emit_key

    def _row(self, key, buf) -> Row:
        vals = dict(fire_seq=buf[-1][0], n_elems=len(buf), sum_value=sum(v for _, v in buf))
        return Row(key=key[0], **vals) if self.emit_key else Row(**vals)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buf = handle.getListState("buf", "seq long, v double")
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        buf = list(self.buf.get()) if self.buf.exists() else []
        buf = [(b[0], b[1]) for b in buf]
        seen = self.seen.get()[0] if self.seen.exists() else 0
        for r in sorted(rows, key=lambda x: x[self.order]):
            buf.append((r[self.order], float(r[self.value])))
            seen += 1
            if self.slide is None:
                if len(buf) == self.size:
                    yield self._row(key, buf)
                    buf = []
            else:
                buf = buf[-self.size :]
                if seen % self.slide == 0:
                    yield self._row(key, buf)
        self.buf.clear()
        if buf:
            self.buf.put(buf)
        self.seen.update((seen,))

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- triggers (T1, T4) and process context

CONTINUE, FIRE, PURGE, FIRE_AND_PURGE = "CONTINUE", "FIRE", "PURGE", "FIRE_AND_PURGE"


class Trigger:
    """A window trigger: each callback returns CONTINUE, FIRE, PURGE or FIRE_AND_PURGE.

    ``count`` is the number of elements in the window after this one.
    """

    def on_element(self, value: float, window_start: int, window_end: int, count: int) -> str:
        return CONTINUE

    def on_late_element(self, value: float, window_start: int, window_end: int, count: int) -> str:
        """An element behind the watermark but within the allowed lateness."""
        return FIRE

    def on_event_time(self, time_ms: int, window_start: int, window_end: int) -> str:
        return FIRE

    def on_processing_time(self, time_ms: int, window_start: int, window_end: int) -> str:
        return CONTINUE

    def on_merge(self, window_start: int, window_end: int, count: int) -> str:
        """Called when sessions merged into ``[window_start, window_end)``."""
        return CONTINUE

    def clear(self, window_start: int, window_end: int) -> None:
        pass


class EventTimeTrigger(Trigger):
    """Default trigger of event-time windows: fire once the watermark passes the end, and
    again for every late element within the allowed lateness."""


class ProcessingTimeTrigger(Trigger):
    """Default trigger of processing-time windows: fire when the clock passes the end."""

    def on_event_time(self, time_ms, window_start, window_end):
        return CONTINUE

    def on_processing_time(self, time_ms, window_start, window_end):
        return FIRE


class CountTrigger(Trigger):
    """Fire every ``n`` elements; at the end of the window do nothing more."""

    def __init__(self, n: int):
        self.n = n

    def on_element(self, value, window_start, window_end, count):
        return FIRE if count % self.n == 0 else CONTINUE

    def on_late_element(self, value, window_start, window_end, count):
        return self.on_element(value, window_start, window_end, count)

    def on_event_time(self, time_ms, window_start, window_end):
        return CONTINUE


def _purging(result: str) -> str:
    return FIRE_AND_PURGE if result == FIRE else result


def _either(a: str, b: str) -> str:
    """Two results for the same element: what either of them asks for."""
    fire = FIRE in (a, b) or FIRE_AND_PURGE in (a, b)
    purge = PURGE in (a, b) or FIRE_AND_PURGE in (a, b)
    return {(False, False): CONTINUE, (True, False): FIRE, (False, True): PURGE, (True, True): FIRE_AND_PURGE}[fire, purge]


class PurgingTrigger(Trigger):
    """Turns every FIRE of the wrapped trigger into FIRE_AND_PURGE."""

    def __init__(self, inner: Trigger):
        self.inner = inner

    def on_element(self, *a):
        return _purging(self.inner.on_element(*a))

    def on_late_element(self, *a):
        return _purging(self.inner.on_late_element(*a))

    def on_event_time(self, *a):
        return _purging(self.inner.on_event_time(*a))

    def on_processing_time(self, *a):
        return _purging(self.inner.on_processing_time(*a))

    def on_merge(self, *a):
        return _purging(self.inner.on_merge(*a))

    def clear(self, *a):
        self.inner.clear(*a)


def _ms(t) -> int:
    return int(t.timestamp() * 1000) if hasattr(t, "timestamp") else int(t)


def with_lateness(df, ts: str, bound_ms: int, size_ms: int, lateness_ms: int):
    """The stream with a watermark wide enough that rows within the allowed lateness reach the
    window processor (which narrows it again)."""
    return df.withWatermark(ts, f"{bound_ms + size_ms + lateness_ms} milliseconds")


class TriggeredWindowProcessor(StatefulProcessor):
    """Keyed tumbling windows driven by a ``Trigger``.

    Event time (the default): per window the state holds a partial aggregate (sum, count) and
    the number of firings; a timer at the window's last millisecond calls ``on_event_time``.
    With ``lateness_ms`` the stream must come through ``with_lateness``; an element behind the
    watermark then calls ``on_late_element``, and the window is removed at end + lateness. Rows
    of windows that are gone are dropped. ``processing_time=True`` (time mode
    ``ProcessingTime``): elements belong to the window of their micro-batch's clock time and a
    timer at its end calls ``on_processing_time``.

    Output rows carry the process context: the watermark and processing time of
    the firing, the key's running element count kept across windows
    (``key_total``, global per-key state) and the window's firing number (0, 1, ...).
    """

    def __init__(
        self, size_ms: int, trigger: Trigger, value: str = "value", ts: str = "ts", lateness_ms: int = 0, processing_time: bool = False
    ):
        self.size, self.trigger, self.value, self.ts, self.lateness = size_ms, trigger, value, ts, lateness_ms
        self.processing = processing_time
        # Spark's watermark is this much behind the windows' own (see with_lateness)
        self.shift = size_ms + lateness_ms if lateness_ms else 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start long", "s double, n long, firings long, ended boolean")
        self.total = handle.getValueState("total", "n long")

    def _now(self, tv: TimerValues) -> int:
        return tv.getCurrentProcessingTimeInMs() if self.processing else tv.getCurrentWatermarkInMs() + self.shift

    def _on_time(self, *a) -> str:
        return self.trigger.on_processing_time(*a) if self.processing else self.trigger.on_event_time(*a)

    def _apply(self, result: str, key, start: int, w: list, tv: TimerValues, total: int) -> Iterator[Row]:
        if result in (FIRE, FIRE_AND_PURGE) and w[1] > 0:
            yield Row(
                key=key[0],
                win_start_ms=start,
                win_end_ms=start + self.size,
                sum_value=w[0],
                cnt=w[1],
                watermark_ms=0 if self.processing else self._now(tv),
                proc_time_ms=tv.getCurrentProcessingTimeInMs(),
                key_total=total,
                firing=w[2],
            )
            w[2] += 1
        if result in (PURGE, FIRE_AND_PURGE):
            w[0], w[1] = 0.0, 0

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        total = self.total.get()[0] if self.total.exists() else 0
        now = self._now(timerValues)
        held: dict[int, list] = {}  # the windows of this micro-batch's rows: read and written once
        for r in rows if self.processing else sorted(rows, key=lambda x: x[self.ts]):
            t = now if self.processing else _ms(r[self.ts])
            start = t - (t % self.size)
            end, last = start + self.size, start + self.size - 1
            if not self.processing and last + self.lateness <= now and (self.lateness or last < now):
                continue  # the window is gone
            w = held.get(start)
            if w is None and self.windows.containsKey((start,)):
                w = held[start] = list(self.windows.getValue((start,)))
            elif w is None:
                w = held[start] = [0.0, 0, 0, False]
                self.handle.registerTimer(last - self.shift)
                if self.lateness:
                    self.handle.registerTimer(last - self.shift + self.lateness)
            late = not self.processing and last <= now
            if late and not w[3]:  # the on-time firing comes before the first late element's
                yield from self._apply(self._on_time(last, start, end), key, start, w, timerValues, total)
                w[3] = True
            w[0], w[1] = w[0] + float(r[self.value]), w[1] + 1
            total += 1
            called = self.trigger.on_late_element if late else self.trigger.on_element
            yield from self._apply(called(float(r[self.value]), start, end, w[1]), key, start, w, timerValues, total)
        for start, w in held.items():
            self.windows.updateValue((start,), tuple(w))
        self.total.update((total,))

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        t = expiredTimerInfo.getExpiryTimeInMs() + self.shift
        total = self.total.get()[0] if self.total.exists() else 0
        # windows have one size, so a timer names its window: the one that ends, the one whose lateness does
        for start_key in sorted({(t + 1 - self.size,), (t + 1 - self.size - self.lateness,)}):
            if not self.windows.containsKey(start_key):
                continue
            start = start_key[0]
            last = start + self.size - 1
            w = list(self.windows.getValue(start_key))
            if not w[3]:
                yield from self._apply(self._on_time(last, start, start + self.size), key, start, w, timerValues, total)
                w[3] = True
                self.windows.updateValue(start_key, tuple(w))
            if t >= last + self.lateness:
                self.trigger.clear(start, start + self.size)
                self.windows.removeKey(start_key)

    def close(self) -> None:
        pass


class SessionTriggerProcessor(StatefulProcessor):
    """Keyed event-time session windows driven by a ``Trigger`` (merging windows).

    Each element opens ``[ts, ts + gap)``; sessions that overlap or touch it are
    merged (``on_merge`` is called for the merged window, then ``on_element``) and the timer
    moves to the merged window's last millisecond, where ``on_event_time`` fires
    and the session is removed. State per key: one (end, sum, count) per open session.
    """

    def __init__(self, gap_ms: int, trigger: Trigger, value: str = "value", ts: str = "ts"):
        self.gap, self.trigger, self.value, self.ts = gap_ms, trigger, value, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getMapState("sessions", "start long", "end long, s double, n long")

    def _row(self, key, start, end, s, n, tv: TimerValues) -> Row:
        return Row(key=key[0], win_start_ms=start, win_end_ms=end, sum_value=s, cnt=n, watermark_ms=tv.getCurrentWatermarkInMs())

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        for r in sorted(rows, key=lambda x: x[self.ts]):
            t = _ms(r[self.ts])
            start, end, s, n = t, t + self.gap, float(r[self.value]), 1
            merged = False
            for (k_start,), (k_end, k_s, k_n) in list(self.sessions.iterator()):
                if k_start <= end and start <= k_end:  # overlap or touch
                    self.handle.deleteTimer(k_end - 1)
                    self.sessions.removeKey((k_start,))
                    start, end, s, n = min(start, k_start), max(end, k_end), s + k_s, n + k_n
                    merged = True
            self.sessions.updateValue((start,), (end, s, n))
            self.handle.registerTimer(end - 1)
            res = self.trigger.on_element(float(r[self.value]), start, end, n)
            if merged:
                res = _either(self.trigger.on_merge(start, end, n), res)
            if res in (FIRE, FIRE_AND_PURGE):
                yield self._row(key, start, end, s, n, timerValues)
            if res in (PURGE, FIRE_AND_PURGE):
                self.sessions.updateValue((start,), (end, 0.0, 0))

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        t = expiredTimerInfo.getExpiryTimeInMs()
        for (k_start,), (k_end, k_s, k_n) in list(self.sessions.iterator()):
            if k_end - 1 == t:
                res = self.trigger.on_event_time(t, k_start, k_end)
                if res in (FIRE, FIRE_AND_PURGE) and k_n > 0:
                    yield self._row(key, k_start, k_end, k_s, k_n, timerValues)
                self.trigger.clear(k_start, k_end)
                self.sessions.removeKey((k_start,))

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- evictors on streams


class Evictor:
    """Removes elements of a window's buffer before and/or after the window
    function runs. Elements are ``(seq, ts_ms, value)`` tuples in arrival order."""

    def evict_before(self, elems: list[tuple]) -> list[tuple]:
        return elems

    def evict_after(self, elems: list[tuple]) -> list[tuple]:
        return elems


class CountEvictor(Evictor):
    """Keep the last ``n`` elements (before the function, or after it)."""

    def __init__(self, n: int, after: bool = False):
        self.n, self.after = n, after

    def _keep(self, elems):
        return elems[-self.n :] if len(elems) > self.n else elems

    def evict_before(self, elems):
        return elems if self.after else self._keep(elems)

    def evict_after(self, elems):
        return self._keep(elems) if self.after else elems


class TimeEvictor(Evictor):
    """Drop elements at or before ``max ts - interval``."""

    def __init__(self, interval_ms: int, after: bool = False):
        self.interval, self.after = interval_ms, after

    def _keep(self, elems):
        if not elems:
            return elems
        cutoff = max(e[1] for e in elems) - self.interval
        return [e for e in elems if e[1] > cutoff]

    def evict_before(self, elems):
        return elems if self.after else self._keep(elems)

    def evict_after(self, elems):
        return self._keep(elems) if self.after else elems


class DeltaEvictor(Evictor):
    """Drop elements whose ``delta(last, x)`` to the last element is >= threshold."""

    def __init__(self, threshold: float, delta: Callable[[float, float], float], after: bool = False):
        self.threshold, self.delta, self.after = threshold, delta, after

    def _keep(self, elems):
        if not elems:
            return elems
        last = elems[-1][2]
        return [e for e in elems if not self.delta(last, e[2]) >= self.threshold]

    def evict_before(self, elems):
        return elems if self.after else self._keep(elems)

    def evict_after(self, elems):
        return self._keep(elems) if self.after else elems


class EvictingWindowProcessor(StatefulProcessor):
    """Global window per key with a count trigger and an evictor: every ``every``
    elements the buffer is passed through ``evict_before``, summed and emitted,
    then passed through ``evict_after`` and kept. Without an evictor that trims
    it the buffer grows with the key, as the library's global windows do.
    Output: (fire_seq, n_elems, sum_value)."""

    def __init__(self, every: int, evictor: Evictor, value: str = "value", order: str = "seq", ts: str | None = None):
        self.every, self.evictor, self.value, self.order, self.ts = every, evictor, value, order, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buf = handle.getListState("elems", "seq long, ts long, v double")
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        elems = [tuple(e) for e in self.buf.get()] if self.buf.exists() else []
        n = self.count.get()[0] if self.count.exists() else 0
        for r in sorted(rows, key=lambda x: x[self.order]):
            t = r[self.ts] if self.ts else 0
            t = int(t.timestamp() * 1000) if hasattr(t, "timestamp") else int(t)
            elems.append((r[self.order], t, float(r[self.value])))
            n += 1
            if n % self.every == 0:
                elems = self.evictor.evict_before(elems)
                yield Row(fire_seq=r[self.order], n_elems=len(elems), sum_value=sum(e[2] for e in elems))
                elems = self.evictor.evict_after(elems)
        self.buf.clear()
        if elems:
            self.buf.put(elems)
        self.count.update((n,))

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- process function with context


class WindowContext:
    """What a window function sees: the window, the times, and two dicts that are kept in the
    state store: ``window_state`` (until the window is cleared) and ``global_state`` (per key)."""

    def __init__(self, start, end, watermark_ms, proc_time_ms, window_state, global_state):
        self.window_start, self.window_end = start, end
        self.watermark_ms, self.proc_time_ms = watermark_ms, proc_time_ms
        self.window_state, self.global_state = window_state, global_state


class WindowFunction:
    """Override ``process`` (yields output tuples behind the key) and, if need be, ``clear``."""

    def process(self, key: tuple, ctx: WindowContext, elements: list[tuple]) -> Iterator[tuple]:
        raise NotImplementedError

    def clear(self, key: tuple, ctx: WindowContext) -> None:
        pass


class ProcessWindowProcessor(StatefulProcessor):
    """Keyed tumbling event-time windows with a user ``WindowFunction`` over the elements
    ``(seq, ts_ms, value)``, fired when the watermark passes the end; an ``Evictor`` trims the
    elements before and after the function. State per key: the elements of its open windows.
    Output: the key, then what ``process`` yields (``names`` are its columns)."""

    def __init__(
        self, size_ms: int, function: WindowFunction, names: list[str], evictor: Evictor | None = None,
        value: str = "value", ts: str = "ts", order: str = "seq",
    ):
        self.size, self.function, self.names, self.evictor = size_ms, function, names, evictor or Evictor()
        self.value, self.ts, self.order = value, ts, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.elements = handle.getMapState("elements", "start long, n long", "seq long, ts long, v double")
        self.counts = handle.getMapState("counts", "start long", "n long")
        self.own = handle.getMapState("own", "start long", "state binary")
        self.shared = handle.getValueState("shared", "state binary")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        counts: dict[int, int] = {}
        for r in rows:
            t = _ms(r[self.ts])
            start = t - (t % self.size)
            if start not in counts:
                counts[start] = self.counts.getValue((start,))[0] if self.counts.containsKey((start,)) else 0
                if counts[start] == 0:
                    self.handle.registerTimer(start + self.size - 1)
            self.elements.updateValue((start, counts[start]), (int(r[self.order]), t, float(r[self.value])))
            counts[start] += 1
        for start, n in counts.items():
            self.counts.updateValue((start,), (n,))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size + 1
        # the window's own elements, by number: other open windows are not looked at
        places = [(start, k) for k in range(self.counts.getValue((start,))[0])]
        found = [tuple(self.elements.getValue(p)) for p in places]
        own = pickle.loads(bytes(self.own.getValue((start,))[0])) if self.own.containsKey((start,)) else {}
        shared = pickle.loads(bytes(self.shared.get()[0])) if self.shared.exists() else {}
        ctx = WindowContext(
            start, start + self.size, timerValues.getCurrentWatermarkInMs(), timerValues.getCurrentProcessingTimeInMs(), own, shared
        )
        kept = self.evictor.evict_before(sorted(found))
        for out in self.function.process(key, ctx, kept):
            yield Row(key=key[0], **dict(zip(self.names, out)))
        self.evictor.evict_after(kept)
        self.function.clear(key, ctx)
        self.shared.update((pickle.dumps(ctx.global_state),))
        for place in places:
            self.elements.removeKey(place)
        self.counts.removeKey((start,))
        if self.own.containsKey((start,)):
            self.own.removeKey((start,))

    def close(self) -> None:
        pass


def use_rocksdb(spark) -> None:
    """transformWithState needs the RocksDB state store provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
