"""Window fixtures (FIXTURES.md section 3): assigners, count windows, evictors, late data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eddyline.operators import count_windows as cw
from eddyline.operators import evictors as ev
from eddyline.operators import late
from eddyline.operators import window_fns as wf
from eddyline.operators import windows as win

T0 = dt.datetime(2024, 1, 1)


def _rows(spark, seconds, key="a", values=None):
    values = values or [1] * len(seconds)
    data = [(i + 1, key, T0 + dt.timedelta(seconds=s), v) for i, (s, v) in enumerate(zip(seconds, values))]
    return spark.createDataFrame(data, "seq long, key string, ts timestamp_ntz, value long")


def _secs(c):
    return int((c - T0).total_seconds())


def test_count_tumbling_drops_remainder(spark):
    df = _rows(spark, list(range(12)))
    out = cw.count_tumbling(df, "key", "seq", 5, F.sum("value").alias("s")).orderBy("win_idx").collect()
    assert [r.s for r in out] == [5, 5]
    assert [r.fire_seq for r in out] == [5, 10]


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_count_sliding_partial_first_firings(spark, hot_rows):
    df = _rows(spark, list(range(7)))
    out = cw.count_sliding(df, "key", "seq", 5, 2, "value", hot_rows=hot_rows).orderBy("fire_rn").collect()
    assert [(r.fire_rn, r.sum_vc) for r in out] == [(2, 2), (4, 4), (6, 5)]


def test_global_window_without_trigger_is_empty(spark):
    assert cw.global_no_trigger(_rows(spark, [0, 1, 2]), "key").count() == 0


def test_global_count_trigger_cumulative_and_purging(spark):
    df = _rows(spark, list(range(9)))
    keep = cw.global_count_trigger(df, "key", "seq", 4, "value").orderBy("fire_seq").collect()
    assert [(r.fire_seq, r.sum_vc) for r in keep] == [(4, 4), (8, 8)]
    purge = cw.global_count_trigger(df, "key", "seq", 4, "value", purge=True).orderBy("fire_seq").collect()
    assert [(r.fire_seq, r.sum_vc) for r in purge] == [(4, 4), (8, 4)]


SESSION_SECONDS = [0, 5, 9, 14, 20]


def test_session_gap_equal_to_limit_merges(spark):
    df = _rows(spark, SESSION_SECONDS)
    out = win.window_agg(df, ["key"], win.session("ts", "5 seconds"), F.count(F.lit(1)).alias("n"))
    got = sorted((_secs(r.win_start), _secs(r.win_end), r.n) for r in out.collect())
    assert got == [(0, 19, 4), (20, 25, 1)]


def test_session_dynamic_gap(spark):
    df = _rows(spark, SESSION_SECONDS)
    second = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    gap = F.when(second > 8, F.lit("6 seconds")).otherwise(F.lit("2 seconds"))
    out = win.window_agg(df, ["key"], win.session("ts", gap), F.count(F.lit(1)).alias("n"))
    got = sorted((_secs(r.win_start), _secs(r.win_end), r.n) for r in out.collect())
    assert got == [(0, 2, 1), (5, 7, 1), (9, 26, 3)]


def test_tumbling_with_negative_offset(spark):
    df = _rows(spark, [0])
    r = win.window_agg(df, ["key"], win.tumbling("ts", "1 day", "-8 hours"), F.count(F.lit(1)).alias("n")).first()
    assert (r.win_start, r.win_end) == (dt.datetime(2023, 12, 31, 16), dt.datetime(2024, 1, 1, 16))


def test_sliding_leading_partial_windows(spark):
    df = _rows(spark, SESSION_SECONDS)
    out = win.window_agg(df, ["key"], win.sliding("ts", "5 seconds", "2 seconds"), F.count(F.lit(1)).alias("n")).collect()
    assert len(out) == 13
    assert min(_secs(r.win_start) for r in out) == -4
    assert {r.n for r in out} == {1}


def test_sliding_offset_larger_than_slide(spark):
    df = _rows(spark, [0, 3600 * 5])
    a = win.window_agg(df, ["key"], win.sliding("ts", "12 hours", "1 hour", "-8 hours"), F.count(F.lit(1)).alias("n"))
    b = win.window_agg(df, ["key"], win.sliding("ts", "12 hours", "1 hour"), F.count(F.lit(1)).alias("n"))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_window_label_and_meta(spark):
    df = spark.createDataFrame([("hello", dt.datetime(2022, 2, 9, 20, 27, 36))], "key string, ts timestamp_ntz")
    out = win.window_agg(df, ["key"], win.tumbling("ts", "5 seconds"), F.count(F.lit(1)).alias("n"))
    r = out.select(wf.label("win_start", "key").alias("l"), win.max_timestamp("win_end").alias("m"), "win_start", "win_end").first()
    assert r.l == "2022-02-09 20:27:35.0:hello"
    assert r.m == dt.datetime(2022, 2, 9, 20, 27, 39, 999000)
    t = out.select(win.window_text("win_start", "win_end").alias("t")).first().t
    assert t == "TimeWindow{start=1644438455000, end=1644438460000}"


def test_fold_refused_on_session_windows():
    with pytest.raises(ValueError):
        wf.check_fold_allowed(win.session("ts", "5 seconds"))


EVICT = [(0, 1), (2, 5), (6, 2), (9, 4)]


def _evict_df(spark):
    df = _rows(spark, [s for s, _ in EVICT], values=[v for _, v in EVICT])
    return df.withColumn("win_start", F.lit(T0))


def _kept(df):
    return [r.value for r in df.orderBy("seq").collect()]


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_count_evictor(spark, hot_rows):
    assert _kept(ev.evict_count(_evict_df(spark), ["key", "win_start"], "seq", 2, hot_rows=hot_rows)) == [2, 4]


def test_time_evictor(spark):
    assert _kept(ev.evict_time(_evict_df(spark), ["key", "win_start"], "ts", "5 seconds")) == [2, 4]


def test_delta_evictor(spark):
    kept = ev.evict_delta(_evict_df(spark), ["key", "win_start"], "seq", "value", lambda last, x: F.abs(last - x), 2)
    assert _kept(kept) == [5, 4]


LATE_ARRIVAL = [1, 20, 2, 21, 3]


def _late_df(spark):
    df = _rows(spark, LATE_ARRIVAL)  # seq = arrival position
    return df


def test_late_rows_go_to_side_output(spark):
    c = late.classify(_late_df(spark), "ts", ["seq"], "5 seconds", "0 seconds", "0 seconds")
    on_time = late.on_time_windows(c, "key", "value")
    assert sorted((_secs(r.win_start), r.cnt) for r in on_time.collect()) == [(0, 1), (20, 2)]
    assert sorted(_secs(r.ts) for r in late.side_output(c).collect()) == [2, 3]


def test_allowed_lateness_refires(spark):
    c = late.classify(_late_df(spark), "ts", ["seq"], "5 seconds", "0 seconds", "60 seconds")
    assert late.side_output(c).count() == 0
    fired = late.allowed_lateness(c, "key", "value", ["seq"])
    w0 = sorted((r.firing, r.cnt) for r in fired.collect() if _secs(r.win_start) == 0)
    assert w0 == [(0, 1), (1, 2), (2, 3)]
    w20 = [(r.firing, r.cnt) for r in fired.collect() if _secs(r.win_start) == 20]
    assert w20 == [(0, 2)]


def test_apply_window_process_function(spark):
    """A Python ProcessWindowFunction: (label, size) per (key, window), matching the count."""
    import pandas as pd

    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("user_id").cast("string").alias("id"), "ts", "event_id"
    )
    tumbled = df.withColumn("win_start", F.window("ts", "1 day").start).withColumn("win_end", F.window("ts", "1 day").end)

    def size(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": [pdf["id"].iloc[0]], "win_start": [pdf["win_start"].iloc[0]], "n": [len(pdf)]})

    got = wf.apply_window(tumbled.repartition(3), ["id"], size, "id string, win_start timestamp_ntz, n long", ["event_id"])
    exp = tumbled.groupBy("id", "win_start").agg(F.count(F.lit(1)).alias("n"))
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_session_windows_prefix_form(spark, hot_rows):
    df = _rows(spark, SESSION_SECONDS)
    out = win.session_windows(df, ["key"], "ts", "5 seconds", F.count(F.lit(1)).alias("n"), order="seq", hot_rows=hot_rows)
    assert sorted((_secs(r.win_start), _secs(r.win_end), r.n) for r in out.collect()) == [(0, 19, 4), (20, 25, 1)]
    second = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    gap = F.when(second > 8, F.lit("6 seconds")).otherwise(F.lit("2 seconds"))
    dyn = win.session_windows(df, ["key"], "ts", gap, F.count(F.lit(1)).alias("n"), order="seq", hot_rows=hot_rows)
    assert sorted((_secs(r.win_start), _secs(r.win_end), r.n) for r in dyn.collect()) == [(0, 2, 1), (5, 7, 1), (9, 26, 3)]


def test_session_windows_hot_split_equals_builtin(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        (F.col("user_id") % 2).cast("string").alias("id"), "ts", "event_id"
    )
    got = win.session_windows(ev, ["id"], "ts", "2 hours", F.count(F.lit(1)).alias("n"), order="event_id", hot_rows=30)
    exp = win.window_agg(ev, ["id"], win.session("ts", "2 hours"), F.count(F.lit(1)).alias("n"))
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0


def test_fold_by_buckets_equals_whole_group_fold(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        (F.col("user_id") % 2).cast("string").alias("id"), "event_id", "event_type"
    )
    # P=4 in tests: a key with half of 1000 rows is hot and split into buckets
    got = wf.fold_concat_by(df, ["id"], "event_id", "event_type", sep=",")
    exp = df.groupBy("id").agg(wf.fold_concat("event_type", "event_id", ",").alias("folded"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_map_groups_runs_across_arrow_batches(spark):
    """Tiny Arrow batches make groups straddle batch edges; each group is still
    seen whole, once, in order (frame and dict results)."""
    import pandas as pd

    from eddyline.operators.groups import map_groups

    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "event_id")

    def as_frame(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = bool((pdf["event_id"].diff().dropna() > 0).all())
        return pd.DataFrame({"user_id": [pdf["user_id"].iloc[0]], "n": [len(pdf)], "ordered": [ordered]})

    def as_dict(pdf: pd.DataFrame) -> dict:
        return {"user_id": int(pdf["user_id"].iloc[0]), "n": len(pdf), "ordered": True}

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        exp = {r.user_id: r["count"] for r in df.groupBy("user_id").count().collect()}
        for fn in (as_frame, as_dict):
            got = map_groups(df, ["user_id"], fn, "user_id long, n long, ordered boolean", ["event_id"]).collect()
            assert {r.user_id: r.n for r in got} == exp and len(got) == len(exp)
            assert all(r.ordered for r in got)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_time_eviction_boundary(spark):
    """An element exactly at ``max ts - interval`` is removed, in the batch and the stream form."""
    from eddyline.streaming.stateful import TimeEvictor

    df = _rows(spark, [3, 4, 5, 9], values=[1, 2, 3, 4])
    kept = ev.evict_time(df, ["key"], "ts", "5 seconds")
    assert sorted(r.value for r in kept.collect()) == [3, 4]
    elems = [(i, s * 1000, float(v)) for i, (s, v) in enumerate([(3, 1), (4, 2), (5, 3), (9, 4)])]
    assert [e[2] for e in TimeEvictor(5000).evict_before(elems)] == [3.0, 4.0]
