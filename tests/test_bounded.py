"""One trigger, evictor or window function class on a table and on a stream: equal rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from eddyline._ship import ship_by_value
from eddyline.streaming import stateful as st
from eddyline.streaming.bounded import run_bounded
from eddyline.streaming.run import run_available
from tests.test_user_windows import BASE, SCHEMA, stream_of, thirds, write_files

ship_by_value(__name__)  # the classes below run inside tasks

TRIGGERED = (
    "key string, win_start_ms long, win_end_ms long, sum_value double, cnt long, "
    "watermark_ms long, proc_time_ms long, key_total long, firing long"
)


class Largest(st.WindowFunction):
    """The largest element of the window and how many there were."""

    def process(self, key, ctx, elements):
        yield ctx.window_start, max(e[2] for e in elements), len(elements)


def rows_of(n=60):
    rng = random.Random(7)
    times = sorted(rng.sample(range(300), n))
    return [(i, rng.choice("ab"), BASE + dt.timedelta(seconds=s), float(rng.randint(1, 40))) for i, s in enumerate(times)]


def spans(rows, size=30):
    """(key, window start in seconds) -> values in order."""
    out = {}
    for _, k, t, v in rows:
        s = int((t - BASE).total_seconds())
        out.setdefault((k, s - s % size), []).append(v)
    return out


def seconds(ms):
    return ms // 1000 - int((BASE - dt.datetime(1970, 1, 1)).total_seconds())


def test_a_trigger_on_a_table_and_on_a_stream(spark, tmp_path):
    rows = rows_of()
    write_files(tmp_path, [*thirds(rows), [(99, "z", BASE + dt.timedelta(days=1), 1.0)]])
    build = lambda s: s.groupBy("key").transformWithState(
        st.TriggeredWindowProcessor(30_000, st.PurgingTrigger(st.CountTrigger(2))), TRIGGERED, "Update", "EventTime"
    )
    table = run_bounded(spark.createDataFrame(rows, SCHEMA), "ts", build)
    stream = run_available(build(stream_of(spark, str(tmp_path), "0 seconds")), "trig", "update")
    pick = lambda df: sorted((r.key, seconds(r.win_start_ms), r.sum_value, r.cnt, r.firing) for r in df.where("key <> 'z'").collect())
    want = [(k, s, sum(v[i : i + 2]), 2, i // 2) for (k, s), v in spans(rows).items() for i in range(0, len(v) - 1, 2)]
    assert pick(table) == sorted(want)
    assert pick(stream) == sorted(want)


def test_default_trigger_fires_every_window_at_the_end(spark):
    rows = rows_of()
    build = lambda s: s.groupBy("key").transformWithState(st.TriggeredWindowProcessor(30_000, st.EventTimeTrigger()), TRIGGERED, "Update", "EventTime")
    out = run_bounded(spark.createDataFrame([*rows, (100, "a", None, 5.0)], SCHEMA).repartition(3), "ts", build)
    assert sorted((r.key, seconds(r.win_start_ms), r.sum_value, r.cnt) for r in out.collect()) == sorted((k, s, sum(v), len(v)) for (k, s), v in spans(rows).items())
    assert run_bounded(spark.createDataFrame([], SCHEMA), "ts", build).collect() == []


def test_window_function_and_evictor_on_a_table(spark):
    rows = rows_of()
    schema = "key string, start long, largest double, n long"
    proc = lambda: st.ProcessWindowProcessor(30_000, Largest(), ["start", "largest", "n"], st.CountEvictor(3))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = run_bounded(df, "ts", lambda s: s.groupBy("key").transformWithState(proc(), schema, "Update", "EventTime"))
    want = sorted((k, s, max(v[-3:]), min(3, len(v))) for (k, s), v in spans(rows).items())
    assert sorted((r.key, seconds(r.start), r.largest, r.n) for r in out.collect()) == want
