"""Streaming: mode equivalence, stateful processors over several micro-batches,
processing-time windows, append-mode firing, late data and restart."""

import datetime as dt
import os
import tempfile
import time

from pyspark.sql import functions as F

from eddyline.functions.text import java_split, parse_sensor
from eddyline.operators import keyed
from eddyline.operators import windows as win
from eddyline.sources.lines import read_lines
from eddyline.streaming import stateful as st
from eddyline.streaming.late_stream import LateWindowOperator
from eddyline.streaming.run import checkpoint_location, foreach_batch_available, run_available
from eddyline._ship import ship_by_value
from tests.conftest import FIXTURES

ship_by_value(__name__)  # test triggers run inside tasks


def _dir_of_files(chunks, prefix="in-"):
    d = tempfile.mkdtemp(prefix=prefix)
    now = time.time() - 1000
    for i, lines in enumerate(chunks):
        p = os.path.join(d, f"part{i:03d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(lines))
        os.utime(p, (now + i, now + i))
    return d


def _sensor_chunks():
    lines = open(os.path.join(FIXTURES, "sensor.txt")).read().splitlines()
    numbered = [f"{i + 1},{x}" for i, x in enumerate(lines)]
    return [numbered[:3], numbered[3:5], numbered[5:]]


def _parsed_stream(spark, d):
    s = read_lines(spark, d, "streaming", max_files_per_trigger=1)
    s = s.select(F.split("value", ",", 2).alias("p")).select(
        F.col("p")[0].cast("long").alias("seq"), F.col("p")[1].alias("value")
    )
    return parse_sensor(s, keep=("seq",))[0]


def test_mode_equivalence_word_count(spark):
    d = _dir_of_files([["hello world", "hello flink"], ["hello spark"], ["hello scala"]])

    def count_words(lines):
        words = lines.select(F.explode(java_split("value", " ")).alias("word"))
        return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))

    batch = {r.word: r.cnt for r in count_words(read_lines(spark, d, "batch")).collect()}
    auto = {r.word: r.cnt for r in count_words(read_lines(spark, d, "automatic")).collect()}
    stream = run_available(count_words(read_lines(spark, d, "streaming", max_files_per_trigger=1)), "wc", "complete")
    assert batch == auto == {r.word: r.cnt for r in stream.collect()}
    assert batch == {"hello": 4, "world": 1, "flink": 1, "spark": 1, "scala": 1}


def _rolling_stream(spark, reducer):
    st.use_rocksdb(spark)
    parsed = _parsed_stream(spark, _dir_of_files(_sensor_chunks()))
    proc = st.RollingProcessor(["id", "ts", "vc"], "id string, ts long, vc double", reducer, order="seq")
    out = parsed.groupBy("id").transformWithState(proc, "seq long, id string, ts long, vc double", "Update", "None")
    return {r.seq: (r.ts, r.vc) for r in run_available(out, "rolling", "update").collect()}


def test_stream_rolling_equals_batch(spark, sensors):
    for reducer, batch in [
        (st.max_by_reducer("vc"), keyed.keyed_max_by(sensors, "id", "vc", "seq", record=("ts", "vc"))),
        (st.latest_max_reducer("vc", ("ts",)), keyed.keyed_reduce_latest_max(sensors, "id", "vc", "seq", latest=("ts",))),
        (st.max_reducer("vc"), keyed.keyed_max(sensors, "id", "vc", "seq", carry=("ts",))),
    ]:
        got = _rolling_stream(spark, reducer)
        assert got == {r.seq: (r.ts, r.vc) for r in batch.collect()}


def test_stream_count_windows(spark):
    st.use_rocksdb(spark)
    chunks = [[f"{i},a,{i},1"] for i in range(1, 13)]
    d = _dir_of_files([[",".join(c[0].split(",")[i] for i in (0, 1, 2, 3))] for c in chunks])
    s = read_lines(spark, d, "streaming", max_files_per_trigger=2)
    s = s.select(F.split("value", ",").alias("p")).select(
        F.col("p")[0].cast("long").alias("seq"), F.col("p")[1].alias("key"), F.col("p")[3].cast("double").alias("value")
    )
    tumble = s.groupBy("key").transformWithState(
        st.CountWindowProcessor(5), "fire_seq long, n_elems long, sum_value double", "Update", "None"
    )
    got = sorted((r.fire_seq, r.sum_value) for r in run_available(tumble, "ct", "update").collect())
    assert got == [(5, 5.0), (10, 5.0)]
    s7 = s.filter("seq <= 7")
    slide = s7.groupBy("key").transformWithState(
        st.CountWindowProcessor(5, 2), "fire_seq long, n_elems long, sum_value double", "Update", "None"
    )
    got = sorted((r.fire_seq, r.sum_value) for r in run_available(slide, "cs", "update").collect())
    assert got == [(2, 2.0), (4, 4.0), (6, 5.0)]


def test_processing_time_windows_cover_each_row_once(spark):
    """Three micro-batches: every row is in one tumbling window, in size / slide sliding ones."""
    d = _dir_of_files([["a b"], ["c"], ["d", "e"]])
    lines = win.with_processing_time(read_lines(spark, d, "streaming", max_files_per_trigger=1))
    n = F.count(F.lit(1)).alias("n")
    tumble = win.window_agg(lines, [], win.tumbling_processing("5 seconds"), n)
    rows = run_available(tumble, "pt", "complete").collect()
    assert sum(r.n for r in rows) == 4 and all(r.win_end - r.win_start == dt.timedelta(seconds=5) for r in rows)
    slide = win.window_agg(lines, [], win.sliding_processing("6 seconds", "2 seconds"), n)
    assert sum(r.n for r in run_available(slide, "ps", "complete").collect()) == 12
    shifted = win.window_agg(lines, [], win.tumbling_processing("1 hour", "-8 minutes"), n)
    assert {r.win_start.minute for r in run_available(shifted, "po", "complete").collect()} == {52}


def test_append_mode_fires_each_window_once(spark):
    base = dt.datetime(2024, 1, 1)
    chunks = [[f"{(base + dt.timedelta(seconds=s)).isoformat(sep=' ')},1"] for s in (1, 2, 7, 12, 30)]
    d = _dir_of_files(chunks)
    s = read_lines(spark, d, "streaming", max_files_per_trigger=1)
    s = s.select(F.split("value", ",").alias("p")).select(
        F.col("p")[0].cast("timestamp").alias("ts"), F.col("p")[1].cast("long").alias("v")
    )
    agg = s.withWatermark("ts", "0 seconds").groupBy(F.window("ts", "5 seconds")).agg(F.sum("v").alias("n"))
    rows = run_available(agg, "ap", "append").collect()
    starts = [r.window.start for r in rows]
    assert len(starts) == len(set(starts))
    assert sorted((r.window.start.second, r.n) for r in rows) == [(0, 2), (5, 1), (10, 1)]


def test_custom_trigger_with_timers(spark):
    st.use_rocksdb(spark)
    base = dt.datetime(2024, 1, 1)
    secs = [0, 1, 2, 3, 11, 30]
    d = _dir_of_files([[f"k,{(base + dt.timedelta(seconds=s)).isoformat(sep=' ')},1"] for s in secs])
    s = read_lines(spark, d, "streaming", max_files_per_trigger=1)
    s = s.select(F.split("value", ",").alias("p")).select(
        F.col("p")[0].alias("key"), F.col("p")[1].cast("timestamp").alias("ts"), F.col("p")[2].cast("double").alias("value")
    )
    proc = st.TriggeredWindowProcessor(10_000, st.CountTrigger(2))
    schema = (
        "key string, win_start_ms long, win_end_ms long, sum_value double, cnt long, "
        "watermark_ms long, proc_time_ms long, key_total long, firing long"
    )
    out = s.withWatermark("ts", "0 seconds").groupBy("key").transformWithState(proc, schema, "Update", "EventTime")
    rows = run_available(out, "trig", "update").collect()
    counts = sorted(r.cnt for r in rows)
    assert counts == [2, 4]  # window [0,10): fires at the 2nd and 4th element
    assert max(r.key_total for r in rows) == 4


def test_late_stream_operator(spark):
    base = dt.datetime(2024, 1, 1)
    arrival = [1, 20, 2, 21, 3]
    d = _dir_of_files([[f"{i},k,{(base + dt.timedelta(seconds=s)).isoformat(sep=' ')},1"] for i, s in enumerate(arrival)])
    s = read_lines(spark, d, "streaming", max_files_per_trigger=1)
    s = s.select(F.split("value", ",").alias("p")).select(
        F.col("p")[0].cast("long").alias("seq"),
        F.col("p")[1].alias("key"),
        F.col("p")[2].cast("timestamp").alias("ts"),
        F.col("p")[3].cast("double").alias("value"),
    )
    for lateness, side, refires in [("0 seconds", [2, 3], []), ("60 seconds", [], [2, 3])]:
        op = LateWindowOperator(checkpoint_location(spark, "late"), "key", "ts", "value", "seq", "5 seconds", "0 seconds", lateness)
        foreach_batch_available(s, op, "late")
        got_side = sorted(r.ts.second for r in op.side_output(spark).collect())
        assert got_side == side
        fired = op.fired(spark).collect()
        w0 = sorted((r.firing, r.cnt) for r in fired if r.win_start.second == 0)
        assert w0 == [(0, 1), (1, 2), (2, 3)][: 1 + len(refires)]
        assert not [r for r in fired if r.win_start.second == 20]
        op.flush(spark)  # the stream has ended: the open window fires
        op.flush(spark)
        assert [(r.firing, r.cnt) for r in op.fired(spark).collect() if r.win_start.second == 20] == [(0, 2)]


def test_restart_resumes_from_checkpoint(spark):
    st.use_rocksdb(spark)
    chunks = _sensor_chunks()
    d = tempfile.mkdtemp(prefix="restart-")
    ck = checkpoint_location(spark, "restart")

    def write(i):
        p = os.path.join(d, f"part{i:03d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(chunks[i]))
        os.utime(p, (time.time() - 100 + i, time.time() - 100 + i))

    out_dir = checkpoint_location(spark, "restart-out")

    def sink(batch, batch_id):  # idempotent per batch: a replay overwrites its own folder
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    def run_once():
        parsed = _parsed_stream(spark, d)
        proc = st.RollingProcessor(["id", "ts", "vc"], "id string, ts long, vc double", st.max_by_reducer("vc"), order="seq")
        out = parsed.groupBy("id").transformWithState(proc, "seq long, id string, ts long, vc double", "Update", "None")
        foreach_batch_available(out, sink, "restart", checkpoint=ck)
        rows = spark.read.parquet(out_dir).collect()
        return {r.seq: (r.ts, r.vc) for r in rows}

    write(0)
    first = run_once()
    write(1)
    write(2)
    second = run_once()  # resumes: only new rows, state carried over
    assert set(first) == {1, 2, 3} and set(second) == {1, 2, 3, 4, 5, 6, 7}
    assert second[7] == (1547718212, 37.1) and second[5] == (1547718207, 36.3)


def _ones_stream(spark, n):
    d = _dir_of_files([[f"{i},a,1"] for i in range(1, n + 1)])
    s = read_lines(spark, d, "streaming", max_files_per_trigger=2)
    return s.select(F.split("value", ",").alias("p")).select(
        F.col("p")[0].cast("long").alias("seq"), F.col("p")[1].alias("key"), F.col("p")[2].cast("double").alias("value")
    )


def test_evict_before_and_after(spark):
    st.use_rocksdb(spark)
    s = _ones_stream(spark, 6)
    schema = "fire_seq long, n_elems long, sum_value double"
    before = s.groupBy("key").transformWithState(st.EvictingWindowProcessor(3, st.CountEvictor(2)), schema, "Update", "None")
    after = s.groupBy("key").transformWithState(
        st.EvictingWindowProcessor(3, st.CountEvictor(2, after=True)), schema, "Update", "None"
    )
    assert sorted((r.fire_seq, r.sum_value) for r in run_available(before, "eb", "update").collect()) == [(3, 2.0), (6, 2.0)]
    assert sorted((r.fire_seq, r.sum_value) for r in run_available(after, "ea", "update").collect()) == [(3, 3.0), (6, 5.0)]


def test_evictor_rules_match_fixture():
    elems = [(1, 0, 1.0), (2, 2000, 5.0), (3, 6000, 2.0), (4, 9000, 4.0)]
    assert [e[2] for e in st.CountEvictor(2).evict_before(elems)] == [2.0, 4.0]
    assert [e[2] for e in st.TimeEvictor(5000).evict_before(elems)] == [2.0, 4.0]
    assert [e[2] for e in st.DeltaEvictor(2, lambda a, b: abs(a - b)).evict_before(elems)] == [5.0, 4.0]


def test_processing_time_session_groups_a_batch(spark):
    d = _dir_of_files([["a", "b", "c"]])
    lines = win.with_processing_time(read_lines(spark, d, "streaming"))
    keyed_lines = lines.withColumn("k", F.lit("all"))  # session windows need a key on streams
    sess = win.window_agg(keyed_lines, ["k"], win.session_processing("5 seconds"), F.count(F.lit(1)).alias("n"))
    rows = run_available(sess, "psess", "complete").collect()
    assert [r.n for r in rows] == [3]  # one micro-batch shares one processing time


def test_line_source_options(spark):
    from eddyline.sources.lines import decode_kafka_value, kafka_options, socket_lines

    sock = socket_lines(spark, "localhost", 9999)  # building the frame connects to nothing
    assert sock.isStreaming and sock.columns == ["value"]
    opts = kafka_options("node01:9092", "gptest", group_id="g1")
    assert opts["subscribe"] == "gptest" and opts["kafka.group.id"] == "g1" and opts["startingOffsets"] == "latest"
    raw = spark.createDataFrame([(b"k", b"sensor_1,1,2.0")], "key binary, value binary")
    assert decode_kafka_value(raw).first().value == "sensor_1,1,2.0"


def test_keyed_operators_same_code_on_streams(spark, sensors):
    """The batch operators themselves switch to stateful processing on a stream."""
    parsed = _parsed_stream(spark, _dir_of_files(_sensor_chunks()))
    cases = [
        (keyed.keyed_max_by(parsed, "id", "vc", "seq", record=("ts", "vc")),
         keyed.keyed_max_by(sensors, "id", "vc", "seq", record=("ts", "vc"))),
        (keyed.keyed_max(parsed, "id", "vc", "seq", carry=("ts",)), keyed.keyed_max(sensors, "id", "vc", "seq", carry=("ts",))),
        (keyed.keyed_sum(parsed, "id", "vc", order="seq", emit="rolling", carry=("ts",)),
         keyed.keyed_sum(sensors, "id", "vc", order="seq", emit="rolling", carry=("ts",))),
        (keyed.keyed_reduce_latest_max(parsed, "id", "vc", "seq", latest=("ts",)),
         keyed.keyed_reduce_latest_max(sensors, "id", "vc", "seq", latest=("ts",))),
    ]
    for stream, batch in cases:
        got = {r.seq: (r.id, r.ts, round(r.vc, 6)) for r in run_available(stream, "same", "update").collect()}
        exp = {r.seq: (r.id, r.ts, round(r.vc, 6)) for r in batch.collect()}
        assert got == exp


def test_stream_count_window_helper(spark):
    from eddyline.operators.count_windows import stream_count_window

    s = _ones_stream(spark, 7)
    out = stream_count_window(s, "key", "seq", "value", 5, 2)
    got = sorted((r.key, r.fire_seq, r.sum_value) for r in run_available(out, "scw", "update").collect())
    assert got == [("a", 2, 2.0), ("a", 4, 4.0), ("a", 6, 5.0)]


class _MergeCounter(st.Trigger):
    """Fires on every merge and at the end of the session."""

    def on_merge(self, window_start, window_end, count):
        return st.FIRE


def test_session_trigger_on_merge(spark):
    st.use_rocksdb(spark)
    base = dt.datetime(2024, 1, 1)
    secs = [0, 5, 9, 14, 20, 60]
    d = _dir_of_files([[f"k,{(base + dt.timedelta(seconds=s)).isoformat(sep=' ')},1"] for s in secs])
    s = read_lines(spark, d, "streaming", max_files_per_trigger=1)
    s = s.select(F.split("value", ",").alias("p")).select(
        F.col("p")[0].alias("key"), F.col("p")[1].cast("timestamp").alias("ts"), F.col("p")[2].cast("double").alias("value")
    )
    schema = "key string, win_start_ms long, win_end_ms long, sum_value double, cnt long, watermark_ms long"
    out = s.withWatermark("ts", "0 seconds").groupBy("key").transformWithState(
        st.SessionTriggerProcessor(5000, _MergeCounter()), schema, "Update", "EventTime"
    )
    rows = run_available(out, "sesstrig", "update").collect()
    t0 = 1704067200000  # 2024-01-01 00:00 UTC in ms (session zone UTC)
    got = sorted(((r.win_start_ms - t0) // 1000, (r.win_end_ms - t0) // 1000, r.cnt) for r in rows)
    # merges at 5, 9, 14 fire with 2, 3, 4 elements; the timers then fire [0,19) and [20,25);
    # the session opened at 60 is still open when the input ends
    assert got == [(0, 10, 2), (0, 14, 3), (0, 19, 4), (0, 19, 4), (20, 25, 1)]


def test_batch_only_forms_explain_themselves_on_streams(spark):
    import pytest

    from eddyline.operators.count_windows import count_sliding, count_tumbling
    from eddyline.operators.prefix import Running, running

    s = _ones_stream(spark, 3)
    with pytest.raises(ValueError, match="stream"):
        running(s, ["key"], ["seq"], [Running("n", "count", F.lit(1))])
    with pytest.raises(ValueError, match="stream_count_window"):
        count_tumbling(s, "key", "seq", 2, F.sum("value").alias("s"))
    assert count_sliding(s, "key", "seq", 5, 2, "value").isStreaming


def test_late_operator_replay_is_idempotent(spark):
    """A replayed micro-batch (same batch id) rewrites the same state and outputs."""
    base = dt.datetime(2024, 1, 1)
    rows = [(i, "k", base + dt.timedelta(seconds=s), 1.0) for i, s in enumerate([1, 20, 2, 21, 3])]
    df = spark.createDataFrame(rows, "seq long, key string, ts timestamp, value double")
    op = LateWindowOperator(checkpoint_location(spark, "replay"), "key", "ts", "value", "seq", "5 seconds", "0 seconds", "60 seconds")
    b0, b1 = df.filter("seq < 2"), df.filter("seq >= 2")
    op(b0, 0)
    op(b1, 1)
    first = sorted(tuple(r) for r in op.fired(spark).collect())
    op(b1, 1)  # replay after a failure
    assert sorted(tuple(r) for r in op.fired(spark).collect()) == first
    assert op.side_output(spark).count() == 0


def test_corrupt_late_state_fails_the_batch(spark):
    import pytest

    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "k", base, 1.0)], "seq long, key string, ts timestamp, value double")
    root = checkpoint_location(spark, "corrupt")
    op = LateWindowOperator(root, "key", "ts", "value", "seq", "5 seconds", "0 seconds")
    op(df, 0)
    spark.createDataFrame([("x",)], "other string").write.mode("overwrite").text(f"{root}/partials/batch_id=0")
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader says
        op(df, 1)


def test_old_versions_of_late_state_go(spark):
    base = dt.datetime(2024, 1, 1)
    op = LateWindowOperator(checkpoint_location(spark, "versions"), "key", "ts", "value", "seq", "5 seconds", "0 seconds")
    for i in range(5):
        op(spark.createDataFrame([(i, "k", base + dt.timedelta(seconds=3 * i), 1.0)], "seq long, key string, ts timestamp, value double"), i)
    assert op._versions(spark) == [3, 4]
    assert sum(r.cnt for r in op.fired(spark).collect()) == 4  # [0,5) and [5,10) have fired


def _timed(spark, secs, value="1", key="k"):
    base = dt.datetime(2024, 1, 1)
    d = _dir_of_files([[f"{i},{key},{(base + dt.timedelta(seconds=s)).isoformat(sep=' ')},{value}"] for i, s in enumerate(secs)])
    s = read_lines(spark, d, "streaming", max_files_per_trigger=1).select(F.split("value", ",").alias("p"))
    return s.select(
        F.col("p")[0].cast("long").alias("seq"), F.col("p")[1].alias("key"), F.col("p")[2].cast("timestamp").alias("ts"),
        F.col("p")[3].cast("double").alias("value"),
    )


T0_MS = 1704067200000  # 2024-01-01 00:00 UTC (session zone UTC)
TRIGGERED = (
    "key string, win_start_ms long, win_end_ms long, sum_value double, cnt long, "
    "watermark_ms long, proc_time_ms long, key_total long, firing long"
)


def test_allowed_lateness_of_the_window_processor(spark):
    st.use_rocksdb(spark)
    s = st.with_lateness(_timed(spark, [1, 20, 2, 21, 3]), "ts", 0, 5000, 60_000)
    proc = st.TriggeredWindowProcessor(5000, st.EventTimeTrigger(), lateness_ms=60_000)
    rows = run_available(s.groupBy("key").transformWithState(proc, TRIGGERED, "Update", "EventTime"), "lateproc", "update").collect()
    assert sorted((r.firing, r.cnt) for r in rows if r.win_start_ms == T0_MS) == [(0, 1), (1, 2), (2, 3)]


def test_sessions_call_on_element_when_they_merge(spark):
    st.use_rocksdb(spark)
    s = _timed(spark, [0, 1, 2, 3]).withWatermark("ts", "0 seconds")
    schema = "key string, win_start_ms long, win_end_ms long, sum_value double, cnt long, watermark_ms long"
    for trigger, counts in ((st.CountTrigger(2), [2, 4]), (st.PurgingTrigger(_MergeCounter()), [1, 1, 2])):
        out = s.groupBy("key").transformWithState(st.SessionTriggerProcessor(5000, trigger), schema, "Update", "EventTime")
        assert sorted(r.cnt for r in run_available(out, "sessmerge", "update").collect()) == counts


def test_purging_trigger_forwards_every_callback():
    class All(st.Trigger):
        def __init__(self):
            self.cleared = []

        def on_processing_time(self, *a):
            return st.FIRE

        def on_merge(self, *a):
            return st.FIRE

        def clear(self, *a):
            self.cleared.append(a)

    inner = All()
    t = st.PurgingTrigger(inner)
    assert {t.on_processing_time(1, 0, 5), t.on_merge(0, 5, 1), t.on_event_time(1, 0, 5)} == {st.FIRE_AND_PURGE}
    t.clear(0, 5)
    assert inner.cleared == [(0, 5)]


def test_processing_time_timers_fire(spark):
    """A query with processing-time timers goes on running, as its timers may; it is stopped here
    once the window has fired."""
    st.use_rocksdb(spark)
    lines = read_lines(spark, _dir_of_files([["k", "k"]]), "streaming").select(F.col("value").alias("key"), F.lit(1.0).alias("value"))
    proc = st.TriggeredWindowProcessor(1000, st.ProcessingTimeTrigger(), processing_time=True)
    out = lines.groupBy("key").transformWithState(proc, TRIGGERED, "Update", "ProcessingTime")
    got = []
    query = (
        out.writeStream.foreachBatch(lambda b, _: got.extend(b.collect()))
        .outputMode("update")
        .option("checkpointLocation", checkpoint_location(spark, "proctimer"))
        .trigger(processingTime="300 milliseconds")
        .start()
    )
    try:
        until = time.time() + 60
        while not got and time.time() < until:
            time.sleep(0.3)
    finally:
        query.stop()
    assert sum(r.cnt for r in got) == 2 and all(r.win_end_ms - r.win_start_ms == 1000 for r in got)


class _Totals(st.WindowFunction):
    """Sum of the window, sum of all windows of the key so far, and calls of clear."""

    def process(self, key, ctx, elements):
        total = sum(e[2] for e in elements)
        ctx.global_state["all"] = ctx.global_state.get("all", 0.0) + total
        ctx.window_state["seen"] = len(elements)
        yield ctx.window_start, total, ctx.global_state["all"], ctx.global_state.get("cleared", 0)

    def clear(self, key, ctx):
        ctx.global_state["cleared"] = ctx.global_state.get("cleared", 0) + ctx.window_state["seen"]


def test_process_function_with_context_and_evictor(spark):
    st.use_rocksdb(spark)
    s = _timed(spark, [0, 1, 2, 11, 12, 40]).withWatermark("ts", "0 seconds")
    schema = "key string, start long, total double, so_far double, cleared long"
    names = ["start", "total", "so_far", "cleared"]
    for evictor, want in ((None, [(0, 3.0, 3.0, 0), (10, 2.0, 5.0, 3)]), (st.CountEvictor(2), [(0, 2.0, 2.0, 0), (10, 2.0, 4.0, 2)])):
        proc = st.ProcessWindowProcessor(10_000, _Totals(), names, evictor)
        out = run_available(s.groupBy("key").transformWithState(proc, schema, "Update", "EventTime"), "ctx", "update").collect()
        assert sorted(((r.start - T0_MS) // 1000, r.total, r.so_far, r.cleared) for r in out) == want


def test_flush_makes_a_bounded_stream_equal_the_batch(spark):
    secs = [1, 2, 7, 12, 30]
    stream = _timed(spark, secs).withWatermark("ts", "0 seconds")
    n = F.sum("value").alias("n")
    flushed = run_available(win.window_agg(stream, ["key"], win.tumbling("ts", "5 seconds"), n), "fl", flush=["key", "win_start", "win_end"])
    base = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame([(i, "k", base + dt.timedelta(seconds=s), 1.0) for i, s in enumerate(secs)], "seq long, key string, ts timestamp, value double")
    want = win.window_agg(batch, ["key"], win.tumbling("ts", "5 seconds"), n)
    assert sorted(map(tuple, flushed.collect())) == sorted(map(tuple, want.collect())) and flushed.count() == 4
    sessions = run_available(win.window_agg(stream, ["key"], win.session("ts", "5 seconds"), n), "fs", "complete")
    want = win.session_windows(batch, ["key"], "ts", "5 seconds", n, order="seq")
    assert sorted(map(tuple, sessions.collect())) == sorted(map(tuple, want.collect()))


def test_stream_reducers_follow_the_batch_on_nulls_and_nan(spark):
    values = ["", "2.0", "NaN", "", "5.0"]
    d = _dir_of_files([[f"{i},k,{v}"] for i, v in enumerate(values)])
    p = F.split("value", ",")
    shape = [p[0].cast("long").alias("seq"), p[1].alias("id"), F.when(p[2] != "", p[2].cast("double")).alias("vc")]
    stream = read_lines(spark, d, "streaming", max_files_per_trigger=1).select(*shape)
    batch = read_lines(spark, d, "batch").select(*shape)
    for op in (
        lambda x: keyed.keyed_max(x, "id", "vc", "seq"),
        lambda x: keyed.keyed_max_by(x, "id", "vc", "seq", record=("vc",)),
        lambda x: keyed.keyed_max_by(x, "id", "vc", "seq", record=("vc",), first=True),
        lambda x: keyed.keyed_reduce_latest_max(x, "id", "vc", "seq"),
        lambda x: keyed.keyed_sum(x, "id", "vc", order="seq", emit="rolling"),
    ):
        got = {r.seq: repr(r.vc) for r in run_available(op(stream), "nulls", "update").collect()}
        assert got == {r.seq: repr(r.vc) for r in op(batch).collect()}
