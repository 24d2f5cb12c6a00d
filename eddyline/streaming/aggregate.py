"""User aggregate functions on the windows of a stream: one accumulator per key and window.

``AggregateWindowProcessor`` keeps the pickled accumulator of every open window in the state
store, folds a micro-batch's rows into it and emits the result when the watermark passes the
window's end. Session windows merge: the open sessions of a key are an ordered list of disjoint
intervals, a row's interval joins those that it meets, and their accumulators are merged.
No element is kept.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from eddyline.operators.udaf import AggregateFunction


def plain(value: Any) -> Any:
    """A value as the batch form hands it to a function: structs are dicts."""
    return value.asDict(recursive=True) if isinstance(value, Row) else value


class Sessions:
    """Disjoint intervals of one key in order, each with an accumulator. Intervals that touch or
    overlap are one (a distance equal to the gap merges, as in the batch form)."""

    def __init__(self, fn: AggregateFunction, found: list[tuple[int, int, Any]]):
        self.fn = fn
        found = sorted(found, key=lambda x: x[0])
        self.starts, self.ends, self.accs = ([x[i] for x in found] for i in range(3))

    def meeting(self, start: int, end: int) -> slice:
        """The intervals that [start, end] meets."""
        lo = bisect_left(self.ends, start)
        hi = lo
        while hi < len(self.starts) and self.starts[hi] <= end:
            hi += 1
        return slice(lo, hi)

    def join(self, start: int, end: int) -> tuple[int, list[int]]:
        """Make [start, end] and all it meets one interval; (its place, the ends that are gone)."""
        at = self.meeting(start, end)
        gone = self.ends[at]
        merged = None
        for acc in self.accs[at]:
            merged = acc if merged is None else self.fn.merge(merged, acc)
        start, end = min([start, *self.starts[at]]), max([end, *gone])
        self.starts[at], self.ends[at] = [start], [end]
        self.accs[at] = [self.fn.create_accumulator() if merged is None else merged]
        return at.start, [e for e in gone if e != end]


class AggregateWindowProcessor(StatefulProcessor):
    """Rows with a window ``_start``, ``_end`` (microseconds) and a ``_value``; ``merging`` windows are
    sessions. Output: the keys, ``_start``, ``_end``, ``_result``, ``_gone``. With ``updates`` every
    changed window is emitted after each micro-batch, and once more with ``_gone`` when it was
    merged into another; else a window is emitted once, when the watermark passes its end. Rows
    of windows that have been emitted are late and dropped. Null values are not added, unless the
    function asks for them."""

    def __init__(self, fn: AggregateFunction, keys: list[str], merging: bool, updates: bool = False):
        self.fn, self.keys, self.merging, self.updates = fn, keys, merging, updates

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "end long", "start long, acc binary")

    def _row(self, key, start, end, acc, gone=False) -> Row:
        result = None if gone else self.fn.get_result(acc)
        return Row(**dict(zip(self.keys, key)), _start=start, _end=end, _result=result, _gone=gone)

    def _add(self, value, acc):
        value = plain(value)
        return acc if value is None and self.fn.skip_nulls else self.fn.add(value, acc)

    @staticmethod
    def _timer(end: int) -> int:
        return -(-end // 1000) - 1  # the last millisecond inside the window

    def _is_late(self, end: int, watermark: int) -> bool:
        return watermark > 0 and self._timer(end) <= watermark

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        changed, gone = self._fold_sessions(rows, watermark) if self.merging else (self._fold_fixed(rows, watermark), {})
        for end, start in gone.items():
            self.open.removeKey((end,))
            if self.updates:
                yield self._row(key, start, end, None, gone=True)
        for end, (start, acc) in changed.items():
            if not self.open.containsKey((end,)):
                self.handle.registerTimer(self._timer(end))
            self.open.updateValue((end,), (start, pickle.dumps(acc)))
            if self.updates:
                yield self._row(key, start, end, acc)

    def _fold_fixed(self, rows: Iterator[Row], watermark: int) -> dict:
        """Windows of one size: an end names its window."""
        accs: dict[int, tuple[int, Any]] = {}
        for r in rows:
            end = r["_end"]
            if self._is_late(end, watermark):
                continue
            if end not in accs:
                held = self.open.getValue((end,)) if self.open.containsKey((end,)) else None
                accs[end] = (r["_start"], pickle.loads(bytes(held[1])) if held else self.fn.create_accumulator())
            accs[end] = (accs[end][0], self._add(r["_value"], accs[end][1]))
        return accs

    def _fold_sessions(self, rows: Iterator[Row], watermark: int) -> tuple[dict, dict]:
        before = {k[0]: v[0] for k, v in self.open.iterator()}
        held = [(v[0], k[0], pickle.loads(bytes(v[1]))) for k, v in self.open.iterator()]
        sessions, touched = Sessions(self.fn, held), set()
        for r in rows:
            start, end = r["_start"], r["_end"]
            meets = sessions.meeting(start, end)
            if self._is_late(max([end, *sessions.ends[meets]]), watermark):
                continue
            at, merged = sessions.join(start, end)
            touched.difference_update(merged)
            touched.add(sessions.ends[at])
            sessions.accs[at] = self._add(r["_value"], sessions.accs[at])
        now = {e: (s, a) for s, e, a in zip(sessions.starts, sessions.ends, sessions.accs)}
        changed = {e: now[e] for e in touched}
        # a session that kept its end but starts earlier replaces the one that was emitted
        return changed, {e: s for e, s in before.items() if e not in now or (self.updates and now[e][0] != s)}

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        last = (at + 1) * 1000
        ends = [last] if self.open.containsKey((last,)) else []
        if self.merging:  # a session may end within a millisecond
            ends += [k[0] for k, _ in self.open.iterator() if last - 1000 < k[0] < last]
        for end in ends:
            start, acc = self.open.getValue((end,))
            if not self.updates:
                yield self._row(key, start, end, pickle.loads(bytes(acc)))
            self.open.removeKey((end,))

    def close(self) -> None:
        pass


class ProcessingSessionProcessor(StatefulProcessor):
    """Sessions by the time at which rows are handled: rows of one micro-batch or of several belong
    to one session while less than the gap passes between them. A key has one open session, as
    time only goes on; a processing-time timer emits it when the gap has passed. Rows have a
    ``_gap`` (milliseconds) and a ``_value``; output: the keys, ``_start``, ``_end`` (microseconds), ``_result``."""

    def __init__(self, fn: AggregateFunction, keys: list[str]):
        self.fn, self.keys = fn, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "start long, end long, acc binary")

    def _row(self, key, start, end, acc) -> Row:
        return Row(**dict(zip(self.keys, key)), _start=1000 * start, _end=1000 * end, _result=self.fn.get_result(acc))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held = self.open.get() if self.open.exists() else None
        start, end, acc = now, now, None
        if held is not None:
            if now <= held[1]:
                start, end, acc = held[0], held[1], pickle.loads(bytes(held[2]))
            else:  # its timer has not run yet
                yield self._row(key, held[0], held[1], pickle.loads(bytes(held[2])))
        acc = self.fn.create_accumulator() if acc is None else acc
        for r in rows:
            end = max(end, now + r["_gap"])
            value = plain(r["_value"])
            acc = acc if value is None and self.fn.skip_nulls else self.fn.add(value, acc)
        self.open.update((start, end, pickle.dumps(acc)))
        self.handle.registerTimer(end)

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        held = self.open.get() if self.open.exists() else None
        if held is not None and held[1] <= expiredTimerInfo.getExpiryTimeInMs():  # not extended since
            yield self._row(key, held[0], held[1], pickle.loads(bytes(held[2])))
            self.open.clear()

    def close(self) -> None:
        pass


class LateWindowProcessor(AggregateWindowProcessor):
    """Fixed windows with allowed lateness and a side output, all in the state store. A window fires
    (``_firing`` 0) when the watermark passes its end; a row that comes later fires it again (1, 2, ...)
    until the watermark passes the end by the lateness; rows that come later still are given out
    as they are (``_side``, with ``_value``). A window without rows in time has no firing 0.
    Output: the keys, ``_start``, ``_end``, ``_result``, ``_firing``, ``_side``, ``_value``."""

    def __init__(self, fn: AggregateFunction, keys: list[str], lateness_us: int):
        super().__init__(fn, keys, merging=False)
        self.lateness = lateness_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "end long", "start long, acc binary, firing long")
        # expiry in milliseconds -> the window that it ends
        self.due = handle.getMapState("due", "at long, end long", "fires boolean")

    def _out(self, key, start, end, acc, firing) -> Row:
        result = self.fn.get_result(acc)
        return Row(**dict(zip(self.keys, key)), _start=start, _end=end, _result=result, _firing=firing, _side=False, _value=None)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held: dict[int, list] = {}
        for r in rows:
            start, end = r["_start"], r["_end"]
            if self._is_late(end + self.lateness, watermark):
                yield Row(**dict(zip(self.keys, key)), _start=start, _end=end, _result=None, _firing=None, _side=True, _value=r["_value"])
                continue
            if end not in held:
                if self.open.containsKey((end,)):
                    found = self.open.getValue((end,))
                    held[end] = [found[0], pickle.loads(bytes(found[1])), found[2]]
                else:
                    held[end] = [start, self.fn.create_accumulator(), 0]
                    self._await(end, watermark)
            late, due = self._is_late(end, watermark), (self._timer(end), end)
            if late and self.due.containsKey(due):  # its timer runs only after this micro-batch's rows
                self.due.removeKey(due)
                yield self._out(key, start, end, held[end][1], 0)
            held[end][1] = self._add(r["_value"], held[end][1])
            if late:
                held[end][2] += 1
                yield self._out(key, start, end, held[end][1], held[end][2])
        for end, (start, acc, firing) in held.items():
            self.open.updateValue((end,), (start, pickle.dumps(acc), firing))

    def _await(self, end: int, watermark: int) -> None:
        if not self._is_late(end, watermark):
            self.due.updateValue((self._timer(end), end), (True,))
            self.handle.registerTimer(self._timer(end))
        if self.lateness or self._is_late(end, watermark):
            self.due.updateValue((self._timer(end + self.lateness), end), (False,))
            self.handle.registerTimer(self._timer(end + self.lateness))

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        # windows end at whole milliseconds: the one that ends now, the one whose lateness does
        for end in sorted({(at + 1) * 1000, (at + 1) * 1000 - self.lateness}):
            if not self.due.containsKey((at, end)):
                continue
            fires = self.due.getValue((at, end))[0]
            self.due.removeKey((at, end))
            start, acc, _ = self.open.getValue((end,))
            if fires:
                yield self._out(key, start, end, pickle.loads(bytes(acc)), 0)
            if not fires or not self.lateness:
                self.open.removeKey((end,))


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
