"""Null and NaN keys and values in the Python operators, against Spark's own aggregates."""

import math

import pytest
from pyspark.sql import functions as F

from eddyline._ship import ship_by_value
from eddyline.functions.text import parse_sensor
from eddyline.operators import window_fns as wf
from eddyline.operators.groups import map_groups
from eddyline.operators.prefix import Running, running
from eddyline.operators.rich_map import SensorLineParser
from eddyline.operators.udaf import AverageFunction, CountFunction, aggregate
from eddyline.operators.udf_reduce import latest_max_reducer, rolling_reduce_fn

ship_by_value(__name__)
NAN = float("nan")


@pytest.fixture(params=[3, 1000])
def batches(spark, request):
    """Several Arrow batches per run of a key, and one."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(request.param))
    yield
    spark.conf.set(name, old)


def plain(rows):
    return sorted(repr(tuple(r)) for r in rows)


@pytest.fixture
def rows(spark):
    keys = [None, 1.0, NAN, 2.0]
    data = [(i, keys[i % 4], None if i % 5 == 0 else (NAN if i == 7 else float(i))) for i in range(1, 41)]
    return spark.createDataFrame(data, "seq long, k double, v double").repartition(3)


def test_aggregate_functions(rows, batches):
    avg = aggregate(rows, ["k"], "v", AverageFunction(), "double", "a")
    assert plain(avg.collect()) == plain(rows.groupBy("k").agg(F.avg("v").alias("a")).collect())
    n = aggregate(rows, ["k"], "v", CountFunction(), "long", "n", max_keys_per_flush=2)
    assert plain(n.collect()) == plain(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect())
    only = aggregate(rows.where("v is null"), ["k"], "v", AverageFunction(), "double", "a")
    assert all(r.a is None for r in only.collect()) and only.count() == 4
    assert aggregate(rows.limit(0), ["k"], "v", AverageFunction(), "double", "a").count() == 0


def test_groups(rows, batches):
    def count(pdf):
        return {"n": len(pdf), "first": int(pdf["seq"].iloc[0])}

    got = map_groups(rows, ["k"], count, "n long, first long", ["seq"]).collect()
    want = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first")).collect()
    assert sorted(map(tuple, got)) == sorted((r.n, r.first) for r in want)
    whole = rows.withColumn("k", F.when(F.col("k") == 1, 7).cast("long"))
    assert sorted(r.n for r in map_groups(whole, ["k"], count, "n long, first long", ["seq"]).collect()) == [10, 30]


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_rolling_reduce(rows, batches, hot_rows):
    for kind in ("double", "int"):
        df = rows.withColumn("k", F.when(~F.isnan("k"), F.col("k")).cast("int")) if kind == "int" else rows
        df = df.withColumn("t", F.col("seq") * 2)
        got = rolling_reduce_fn(df, "k", "seq", ["t", "v"], latest_max_reducer("v", ("t",)), hot_rows)
        want = running(df, ["k"], ["seq"], [Running("m", "max", "v")])
        assert plain(got.select("seq", "k", "t", F.col("v").alias("m")).collect()) == plain(want.select("seq", "k", "t", "m").collect())


def test_window_reduce_and_fold(spark, batches):
    from eddyline.operators import windows as win

    data = [(i, None if i % 3 else "a", f"2024-01-01 00:00:{i:02d}", float(i % 4)) for i in range(20)]
    df = spark.createDataFrame(data, "seq long, k string, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp"))
    got = wf.window_reduce(df, ["k"], "ts", lambda ts: win.tumbling(ts, "5 seconds"), ["seq", "v"], wf.smaller_record("v", "seq"))
    want = df.groupBy("k", F.window("ts", "5 seconds").start.alias("win_start")).agg(F.min(F.struct("v", "seq")).alias("m"))
    assert plain(got.select("k", "win_start", "v", "seq").collect()) == plain(want.select("k", "win_start", "m.v", "m.seq").collect())
    folded = wf.window_fold(df, ["k"], win.tumbling("ts", "5 seconds"), "seq", F.lit(""), lambda a, x: F.concat(a, x["seq"].cast("string"), F.lit(",")), ["seq"])
    parts = [r.folded for r in folded.where("k is null").orderBy("win_start").collect()]
    assert "".join(parts) == "".join(f"{i}," for i in range(20) if i % 3)
    with pytest.raises(ValueError, match="session"):
        wf.window_fold(df, ["k"], win.session("ts", "5 seconds"), "seq", F.lit(0), lambda a, x: a, ["seq"])
    with pytest.raises(ValueError, match="session"):
        wf.window_reduce(df, ["k"], "ts", lambda ts: win.session(ts, "5 seconds"), ["seq"], wf.smaller_record("seq", "seq"))


LINES = {  # line -> accepted
    "a,1,2.5": True, "a,+1,1.5d": True, "a,-7,2F": True, "a,1, 3.0 ": True, "a,1,NaN": True, "a,1,-Infinity": True, "a,1,1e3,extra": True,
    "a,1,": False, "a,1,inf": False, "a,1,nan": False, "a,1,infinity": False, "a,1,1_0": False, "a, 1,2": False, "a,1.0,2": False, "a,1": False,
    "a,9223372036854775808,1": False, "a,1,NaNd": False, "": False,
}


def test_both_parsers_take_the_same_lines(spark):
    for line, fine in LINES.items():
        df = spark.createDataFrame([(line,)], "value string")
        good, _ = parse_sensor(df, on_error="drop")
        assert (good.count() == 1) == fine, line
        if fine:
            want, got = good.first(), SensorLineParser.parse(line)
            assert repr(tuple(want)) == repr(got)
        else:
            with pytest.raises(ValueError):
                SensorLineParser.parse(line)


def test_a_bad_line_fails_whatever_is_asked(spark):
    df = spark.createDataFrame([("a,1,2.0",), ("a,x,2.0",)], "value string")
    parsed, _ = parse_sensor(df)
    for action in (parsed.count, parsed.select("id").collect, parsed.groupBy("id").count().collect):
        with pytest.raises(Exception, match="bad sensor line"):
            action()


def test_window_text_in_another_time_zone(spark):
    from eddyline.operators import windows as win

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.sql("SELECT timestamp_millis(1704067200000) a, timestamp_millis(1704067205000) b, TIMESTAMP_NTZ'2024-01-01 00:00:00' c")
        assert df.select(win.window_text("a", "b")).first()[0] == "TimeWindow{start=1704067200000, end=1704067205000}"
        assert df.select(win.window_text("c", "c")).first()[0] == "TimeWindow{start=1704067200000, end=1704067200000}"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_carried_fields_need_an_order(spark):
    from eddyline.operators import keyed

    df = spark.createDataFrame([(1, "a", 2.0)], "seq long, id string, vc double")
    with pytest.raises(ValueError, match="order"):
        keyed.keyed_sum(df, "id", "vc", carry=("seq",))
