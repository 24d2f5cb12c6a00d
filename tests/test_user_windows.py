"""User aggregate and reduce functions: the same class on tables and streams, on fixed and session
windows, over several micro-batches and a restart."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from eddyline._ship import ship_by_value
from eddyline.operators import user_windows as uw
from eddyline.operators import window_fns as wf
from eddyline.operators import windows as win
from eddyline.operators.udaf import AggregateFunction, AverageFunction, CountFunction
from eddyline.sources.lines import read_lines
from eddyline.streaming.aggregate import Sessions
from eddyline.streaming.run import checkpoint_location, foreach_batch_available, run_available

ship_by_value(__name__)  # the functions below run inside tasks

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "seq long, key string, ts timestamp, value double"


class Spread(AggregateFunction):
    """Largest less smallest value, and how many: no built-in aggregate, no inverse."""

    def create_accumulator(self):
        return None, None, 0

    def add(self, value, acc):
        return self.merge(acc, (value, value, 1))

    def merge(self, a, b):
        if a[0] is None or b[0] is None:
            return b if a[0] is None else a
        return min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2]

    def get_result(self, acc):
        return None if acc[0] is None else {"spread": acc[1] - acc[0], "n": acc[2]}


SPREAD = "struct<spread:double,n:bigint>"


def rows_of(n=60, keys=("a", "b", None), seed=1, reach=300, late=0):
    """Rows in about the order of time; ``late`` seconds out of order at most."""
    rng = random.Random(seed)
    times = sorted(rng.randrange(reach) for _ in range(n))
    out = []
    for i, s in enumerate(times):
        s = max(0, s - rng.randint(0, late))
        out.append((i, rng.choice(keys), BASE + dt.timedelta(seconds=s), None if rng.random() < 0.1 else float(rng.randint(0, 40))))
    return out


def as_lines(rows):
    return [f"{i},{'' if k is None else k},{t.isoformat(sep=' ')},{'' if v is None else v}" for i, k, t, v in rows]


def write_files(folder, chunks, first=0):
    now = time.time() - 1000
    for i, chunk in enumerate(chunks, first):
        path = os.path.join(folder, f"part{i:03d}.txt")
        with open(path, "w") as f:
            f.write("\n".join(as_lines(chunk)))
        os.utime(path, (now + i, now + i))


def parsed(lines):
    p = F.split("value", ",")
    empty = lambda c: F.when(c != "", c)
    return lines.select(
        p[0].cast("long").alias("seq"), empty(p[1]).alias("key"), p[2].cast("timestamp").alias("ts"), empty(p[3]).cast("double").alias("value")
    )


def stream_of(spark, folder, watermark="1 hour"):
    return parsed(read_lines(spark, folder, "streaming", max_files_per_trigger=1)).withWatermark("ts", watermark)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def thirds(rows):
    return [rows[:20], rows[20:40], rows[40:]]


def tumbling(ts):
    return win.tumbling(ts, "20 seconds", "-3 seconds")


def sliding(ts):
    return win.sliding(ts, "20 seconds", "8 seconds")


def sessions_by_hand(rows, gap):
    """(key, start, end, values) of the sessions, rows joined in order of time."""
    out = []
    for key in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == key), key=lambda r: r[2])
        now = None
        for _, _, t, v in mine:
            g = dt.timedelta(seconds=gap(v) if callable(gap) else gap)
            if now and t <= now[2]:
                now[2] = max(now[2], t + g)
                now[3].append(v)
            else:
                now = [key, t, t + g, [v]]
                out.append(now)
    return out


def spread_of(values):
    known = [v for v in values if v is not None]
    return (max(known) - min(known), len(known)) if known else None


@pytest.mark.parametrize("window", [tumbling, sliding])
def test_fixed_windows_stream_equals_batch(spark, tmp_path, window):
    rows = rows_of(late=15)
    write_files(tmp_path, thirds(rows))
    batch = uw.window_aggregate(spark.createDataFrame(rows, SCHEMA), ["key"], "ts", window, "value", Spread(), SPREAD)
    stream = uw.window_aggregate(stream_of(spark, str(tmp_path)), ["key"], "ts", window, "value", Spread(), SPREAD, updates=True)
    assert plain(uw.last_updates(stream, ["key"], "fixed")) == plain(batch)
    assert batch.count() > 20 and any(r.result is None for r in batch.collect())


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_sessions_batch(spark, hot_rows):
    """A hot key is cut into buckets; sessions that go on across their borders are one."""
    rows = rows_of(n=200, keys=("a", "a", "b", None), reach=900)
    out = uw.session_aggregate(spark.createDataFrame(rows, SCHEMA).repartition(4), ["key"], "ts", "5 seconds", "value", Spread(), SPREAD, order="seq", hot_rows=hot_rows)
    got = sorted(((r.key, r.win_start, r.win_end, tuple(r.result) if r.result else None) for r in out.collect()), key=repr)
    want = sorted(((k, s, e, spread_of(v)) for k, s, e, v in sessions_by_hand(rows, 5)), key=repr)
    assert got == want and len(want) > 30


def test_sessions_stream_equals_batch(spark, tmp_path):
    """Three micro-batches of rows out of order: sessions grow, merge, and take over each other."""
    rows = rows_of(late=40)
    write_files(tmp_path, thirds(rows))
    df = spark.createDataFrame(rows, SCHEMA)
    stream = uw.session_aggregate(stream_of(spark, str(tmp_path)), ["key"], "ts", "9 seconds", "value", Spread(), SPREAD, updates=True)
    want = plain(uw.session_aggregate(df, ["key"], "ts", "9 seconds", "value", Spread(), SPREAD, order="seq"))
    assert plain(uw.last_updates(stream, ["key"], "sess")) == want and len(want) > 5


def test_dynamic_gap_on_both(spark, tmp_path):
    rows = rows_of(n=60, keys=("a",), reach=400, late=10)
    write_files(tmp_path, thirds(rows))
    gap = F.when(F.col("value") > 20, "12 seconds").otherwise("4 seconds")
    df = spark.createDataFrame(rows, SCHEMA)
    batch = uw.session_aggregate(df, ["key"], "ts", gap, "value", CountFunction(), "bigint", "n", order="seq")
    stream = uw.session_aggregate(stream_of(spark, str(tmp_path)), ["key"], "ts", gap, "value", CountFunction(), "bigint", "n", updates=True)
    want = sessions_by_hand(rows, lambda v: 12 if v is not None and v > 20 else 4)
    assert plain(batch) == sorted(((k, s, e, len(v)) for k, s, e, v in want), key=repr)
    assert plain(uw.last_updates(stream, ["key"], "dyn")) == plain(batch)


def test_restart_goes_on_with_the_accumulators(spark, tmp_path):
    """Two micro-batches, a stop, a third: the windows emitted are those of one run over all rows."""
    rows = rows_of(n=60, keys=("a", "b"), late=8) + [(99, "a", BASE + dt.timedelta(seconds=5000), 1.0)]
    chunks = [rows[:20], rows[20:40], rows[40:60], rows[60:]]
    folder = tmp_path / "in"
    folder.mkdir()
    write_files(folder, chunks[:2])
    ck = checkpoint_location(spark, "restart")
    got = []

    def keep(batch, batch_id):
        got.extend(tuple(r) for r in batch.collect())

    def run():
        s = stream_of(spark, str(folder), "10 seconds")
        out = uw.session_aggregate(s, ["key"], "ts", "9 seconds", "value", AverageFunction(), "double", "avg_v")
        foreach_batch_available(out, keep, "restart", ck)

    run()
    early = len(got)
    write_files(folder, chunks[2:3], 2)
    write_files(folder, chunks[3:], 3)
    run()
    df = spark.createDataFrame(rows, SCHEMA)
    want = uw.session_aggregate(df, ["key"], "ts", "9 seconds", "value", AverageFunction(), "double", "avg_v", order="seq")
    assert 0 < early < len(got)
    assert sorted(got, key=repr) == plain(want.where("win_end < '2024-01-01 01:00:00'"))


def test_append_fires_once_and_drops_late_rows(spark, tmp_path):
    rows = [(i, "k", BASE + dt.timedelta(seconds=s), 1.0) for i, s in enumerate([1, 2, 30, 3, 31, 60])]
    write_files(tmp_path, [[r] for r in rows])
    s = stream_of(spark, str(tmp_path), "0 seconds")
    out = uw.window_aggregate(s, ["key"], "ts", lambda ts: win.tumbling(ts, "10 seconds"), "value", CountFunction(), "bigint", "n")
    got = sorted(((r.win_start - BASE).seconds, r.n) for r in run_available(out, "once").collect())
    assert got == [(0, 2), (30, 2)]  # the row of second 3 came after its window had fired


@pytest.mark.parametrize("lateness", [0, 6, 60])
def test_late_windows_in_the_state_store_equal_the_batch(spark, tmp_path, lateness):
    """One row a micro-batch, with a restart: firings and side output are those of the batch form."""
    from eddyline.operators import late

    secs = [1, 20, 2, 21, 3, 22, 17, 40, 26, 18, 3, 70]
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [(i, "k", BASE + dt.timedelta(seconds=s), float(s)) for i, s in enumerate(secs)]
    ck, got = checkpoint_location(spark, "late"), []

    def run():
        s = parsed(read_lines(spark, str(folder), "streaming", max_files_per_trigger=1))
        out = uw.late_windows(
            s, ["key"], "ts", lambda ts: win.tumbling(ts, "5 seconds"), "value", CountFunction(), "0 seconds", f"{lateness} seconds", "bigint", "cnt"
        )
        foreach_batch_available(out, lambda b, _: got.extend(b.collect()), "late", ck)

    for part in (rows[:6], rows[6:]):
        write_files(folder, [[r] for r in part], part[0][0])
        run()
    df = spark.createDataFrame(rows, SCHEMA)
    batch = late.classify(df, "ts", ["seq"], "5 seconds", "0 seconds", f"{lateness} seconds")
    side = sorted(r.value for r in late.side_output(batch).collect())
    fired = sorted((r.win_start, r.firing, r.cnt) for r in late.allowed_lateness(batch, "key", "value", ["seq"]).collect())
    assert sorted(r.value for r in got if r.side) == side and (lateness == 60 or side)
    # the batch form also fires the window that is still open at the end
    last = BASE + dt.timedelta(seconds=70)
    assert sorted((r.win_start, r.firing, r.cnt) for r in got if not r.side) == [x for x in fired if x[0] < last]


def test_processing_time_sessions_over_micro_batches(spark, tmp_path):
    """Three micro-batches within the gap are one session; one after it is a second."""
    s = parsed(read_lines(spark, str(tmp_path), "streaming", max_files_per_trigger=1))
    out = uw.processing_sessions(s, ["key"], "6 seconds", "value", CountFunction(), "bigint", "n")
    got, ids = [], []

    def keep(batch, batch_id):
        found = batch.collect()
        got.extend(found)
        ids.append(batch_id)

    query = (
        out.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", checkpoint_location(spark, "psess"))
        .trigger(processingTime="200 milliseconds").start()
    )

    def wait(done, seconds=90):
        until = time.time() + seconds
        while not done() and time.time() < until:
            assert query.isActive, query.exception()
            time.sleep(0.2)
        assert done()

    def taken():  # rows that the query has read
        return sum(p["numInputRows"] for p in query.recentProgress)

    try:
        for k in range(3):
            write_files(tmp_path, [[(k, "k", BASE, 1.0), (k, "k", BASE, None)]], k)
            wait(lambda k=k: taken() >= 2 * (k + 1))
        wait(lambda: len(got) == 1)
        write_files(tmp_path, [[(9, "k", BASE, 1.0)]], 9)
        wait(lambda: len(got) == 2)
    finally:
        query.stop()
    assert [r.n for r in got] == [6, 1]
    assert got[0].win_end <= got[1].win_start and (got[0].win_end - got[0].win_start).total_seconds() >= 6
    with pytest.raises(ValueError, match="processing time"):
        uw.processing_sessions(spark.createDataFrame([], SCHEMA), ["key"], "6 seconds", "value", CountFunction())


def test_elements_with_one_order_number_are_two(spark, tmp_path):
    """The process function sees every element, also those that share their order number."""
    from eddyline.streaming import stateful as st

    class All(st.WindowFunction):
        def process(self, key, ctx, elements):
            yield ctx.window_start, len(elements), sum(e[2] for e in elements)

    st.use_rocksdb(spark)
    rows = [(1, "k", BASE, 1.0), (1, "k", BASE, 2.0), (1, "k", BASE + dt.timedelta(seconds=11), 4.0), (2, "k", BASE + dt.timedelta(seconds=90), 8.0)]
    write_files(tmp_path, [rows[:2], rows[2:3], rows[3:]])
    s = stream_of(spark, str(tmp_path), "0 seconds")
    proc = st.ProcessWindowProcessor(10_000, All(), ["start", "n", "total"])
    out = s.groupBy("key").transformWithState(proc, "key string, start long, n long, total double", "Update", "EventTime")
    assert sorted((r.n, r.total) for r in run_available(out, "ctx", "update").collect()) == [(1, 4.0), (2, 3.0)]


def test_current_time_millis(spark):
    from eddyline.functions.clock import current_time_millis

    before = int(time.time() * 1000)
    rows = spark.range(5).select(current_time_millis().alias("t")).collect()
    assert len({r.t for r in rows}) == 1 and before - 1000 <= rows[0].t <= time.time() * 1000 + 1000


def test_reduce_on_sessions_and_streams(spark, tmp_path):
    rows = [(i, k, t, v or 0.0) for i, k, t, v in rows_of(late=10, keys=("a", "b"))]
    write_files(tmp_path, thirds(rows))
    df = spark.createDataFrame(rows, SCHEMA)
    least = wf.smaller_record("value", "seq")
    fields = ["seq", "value"]
    for more in (dict(win=tumbling), dict(win=None, gap="6 seconds")):
        extra = {} if more["win"] else dict(order="seq")
        batch = wf.window_reduce(df, ["key"], "ts", more["win"], fields, least, gap=more.get("gap"), **extra)
        stream = wf.window_reduce(stream_of(spark, str(tmp_path)), ["key"], "ts", more["win"], fields, least, gap=more.get("gap"), updates=True)
        assert plain(uw.last_updates(stream, ["key"], "red")) == plain(batch)
    want = [(k, s, e, *min((v, i) for i, kk, t, v in rows if kk == k and s <= t < e)[::-1]) for k, s, e, _ in sessions_by_hand(rows, 6)]
    assert plain(batch) == sorted(want, key=repr)


def test_interval_merge_matches_sorting(spark):
    rng = random.Random(2)
    for _ in range(50):
        got = Sessions(CountFunction(), [])
        given = [(s := rng.randrange(200), s + rng.randint(1, 9)) for _ in range(40)]
        for s, e in given:
            at, _ = got.join(s, e)
            got.accs[at] += 1
        want = []
        for s, e in sorted(given):
            if want and s <= want[-1][1]:
                want[-1] = (want[-1][0], max(e, want[-1][1]), want[-1][2] + 1)
            else:
                want.append((s, e, 1))
        assert list(zip(got.starts, got.ends, got.accs)) == want


def test_nulls_empty_and_times_without_zone(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert uw.window_aggregate(none, ["key"], "ts", tumbling, "value", Spread(), SPREAD).collect() == []
    assert uw.session_aggregate(none, ["key"], "ts", "5 seconds", "value", Spread(), SPREAD).collect() == []
    df = spark.createDataFrame([(1, None, None, 1.0), (2, None, BASE, None), (3, float("nan"), BASE, 2.0)], "seq long, key double, ts timestamp_ntz, value double")
    out = uw.session_aggregate(df, ["key"], "ts", "5 seconds", "value", CountFunction(), "bigint", "n")
    assert out.schema["win_start"].dataType == df.schema["ts"].dataType
    assert sorted((str(r.key), r.win_start, r.win_end, r.n) for r in out.collect()) == [
        (k, BASE, BASE + dt.timedelta(seconds=5), 1) for k in ("None", "nan")
    ]
    with pytest.raises(ValueError, match="session"):
        uw.window_aggregate(df, ["key"], "ts", lambda ts: win.session(ts, "5 seconds"), "value", Spread(), SPREAD)
    with pytest.raises(ValueError, match="gap"):
        wf.window_reduce(df, ["key"], "ts", None, ["value"], lambda a, b: a)
