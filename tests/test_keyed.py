"""Golden results of the reference programs (word count, rolling sensor aggregates)."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from eddyline.functions.text import java_split
from eddyline.operators import keyed
from eddyline.operators.prefix import Running, running
from tests.conftest import FIXTURES

TUTORIAL = {"pon": 2, "hello": 2, "log": 3, "xml": 3, "exe": 1, "java": 3, "python": 3, "txt": 1, "batch": 1, "count": 1, "word": 1}


def _hello_words(spark):
    lines = spark.read.text(os.path.join(FIXTURES, "hello.txt"))
    lines = lines.withColumn("ln", F.monotonically_increasing_id())
    return lines.select("ln", F.posexplode(java_split("value", " ")).alias("pos", "word"))


def test_text_scan_has_no_extra_line(spark):
    assert spark.read.text(os.path.join(FIXTURES, "hello.txt")).count() == 4


def test_word_pairs_and_final_count(spark):
    pairs = keyed.word_pairs(_hello_words(spark))
    assert pairs.count() == 8 and {r.one for r in pairs.collect()} == {1}
    final = keyed.keyed_sum(pairs, "word", "one")
    assert {r.word: r.one for r in final.collect()} == {"hello": 4, "world": 1, "flink": 1, "spark": 1, "scala": 1}


def test_rolling_count_per_key(spark):
    w = _hello_words(spark).withColumn("seq", F.col("ln") * 100 + F.col("pos"))
    pairs = w.select("word", "seq", F.lit(1).cast("long").alias("one"))
    out = keyed.keyed_sum(pairs, "word", "one", order="seq", emit="rolling")
    got = sorted((r.word, r.one) for r in out.collect())
    assert [c for wd, c in got if wd == "hello"] == [1, 2, 3, 4]
    assert all(c == 1 for wd, c in got if wd != "hello")


def test_tutorial_word_multiset(spark):
    rows = [(i, w) for i, w in enumerate(w for w, n in TUTORIAL.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "seq long, word string").withColumn("one", F.lit(1).cast("long"))
    final = keyed.keyed_sum(df, "word", "one")
    assert {r.word: r.one for r in final.collect()} == TUTORIAL
    rolling = keyed.keyed_sum(df, "word", "one", order="seq", emit="rolling")
    per = {}
    for r in rolling.orderBy("seq").collect():
        per.setdefault(r.word, []).append(r.one)
    assert per == {w: list(range(1, n + 1)) for w, n in TUTORIAL.items()}
    assert rolling.count() == 21


def _s1(df):
    return [(r.ts, r.vc) for r in df.filter("id = 'sensor_1'").orderBy("seq").collect()]


def test_rolling_max_keeps_first_fields(sensors):
    out = keyed.keyed_max(sensors, "id", "vc", "seq", carry=("ts",))
    assert _s1(out) == [(1547718199, 35.8), (1547718199, 36.3), (1547718199, 36.3), (1547718199, 37.1)]
    others = {r.id: (r.ts, r.vc) for r in out.filter("id != 'sensor_1'").collect()}
    assert others == {"sensor_6": (1547718201, 15.4), "sensor_7": (1547718202, 6.7), "sensor_10": (1547718205, 38.1)}


def test_rolling_max_by(sensors):
    out = keyed.keyed_max_by(sensors, "id", "vc", "seq", record=("ts", "vc"))
    assert _s1(out) == [(1547718199, 35.8), (1547718207, 36.3), (1547718207, 36.3), (1547718212, 37.1)]


def test_rolling_reduce(sensors):
    out = keyed.keyed_reduce_latest_max(sensors, "id", "vc", "seq", latest=("ts",))
    assert _s1(out) == [(1547718199, 35.8), (1547718207, 36.3), (1547718209, 36.3), (1547718212, 37.1)]


def test_max_by_ties(spark, sensors):
    extra = spark.createDataFrame([(8, "sensor_1", 1547718215, 37.1)], sensors.schema)
    df = sensors.unionByName(extra)
    last = keyed.keyed_max_by(df, "id", "vc", "seq", record=("ts", "vc"), first=False)
    first = keyed.keyed_max_by(df, "id", "vc", "seq", record=("ts", "vc"), first=True)
    assert _s1(last)[-1] == (1547718215, 37.1)
    assert _s1(first)[-1] == (1547718212, 37.1)
    fin = keyed.keyed_max_by(df, "id", "vc", "seq", record=("ts", "vc"), emit="final")
    assert fin.filter("id = 'sensor_1'").first().ts == 1547718215


def test_final_forms(sensors):
    fmax = {r.id: (r.ts, r.vc) for r in keyed.keyed_max(sensors, "id", "vc", "seq", emit="final", carry=("ts",)).collect()}
    assert fmax["sensor_1"] == (1547718199, 37.1)
    fred = {r.id: (r.ts, r.vc) for r in keyed.keyed_reduce_latest_max(sensors, "id", "vc", "seq", latest=("ts",), emit="final").collect()}
    assert fred["sensor_1"] == (1547718212, 37.1)


def test_duplicates_survive_collection(spark):
    from eddyline.sources.collection import from_rows

    df = from_rows(spark, [("21", 1212, 12.1)] * 3)
    assert df.count() == 3


def test_prefix_hot_key_split_matches_plain_window(spark):
    """Force every key to be split into many buckets and compare with a plain window."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_id").alias("seq"), (F.col("user_id") % 2).cast("string").alias("id"), "ts", F.col("value").alias("vc")
    )
    specs = [
        Running("s", "sum", F.col("vc")),
        Running("c", "count", F.lit(1)),
        Running("mx", "max", "vc"),
        Running("mn", "min", "vc"),
        Running("f", "first", "ts"),
        Running("l", "last", "ts"),
    ]
    for inclusive in (True, False):
        got = running(ev, ["id"], ["seq"], specs, inclusive=inclusive, hot_rows=37)
        w = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        exp = ev.select(
            "*",
            F.sum("vc").over(w).alias("s"),
            F.count(F.lit(1)).over(w).alias("c"),
            F.max("vc").over(w).alias("mx"),
            F.min("vc").over(w).alias("mn"),
            F.first("ts").over(w).alias("f"),
            F.last("ts").over(w).alias("l"),
        )
        g = got.withColumn("s", F.round("s", 2))
        e = exp.withColumn("s", F.round("s", 2))
        assert g.exceptAll(e).count() == 0 and e.exceptAll(g).count() == 0
    glob = running(ev, [], ["seq"], [Running("m", "max", "ts")], inclusive=False)
    ref = ev.select("*", F.max("ts").over(Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)).alias("m"))
    assert glob.exceptAll(ref).count() == 0 and ref.exceptAll(glob).count() == 0


def test_prefix_hot_plan_is_bounded(spark):
    """No hot key: one shuffle and a window, nothing else. Hot keys: the data is
    still shuffled once; the bounded hot/offset tables come back as broadcasts."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "value")
    cold = running(ev, ["user_id"], ["event_id"], [Running("s", "sum", "value")])
    plan = cold._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    hot = running(ev, ["user_id"], ["event_id"], [Running("s", "sum", "value")], hot_rows=20)
    hot.collect()
    plan = hot._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "ReusedExchange" in plan
    # one scan and one shuffle of the rows; the other exchange moves the buckets' totals
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning(user_id#") - plan.count("ReusedExchange") == 2


def test_an_outlier_moves_no_boundary(spark):
    """One row at 0 among millisecond epochs: buckets within 2x of equal, keyed and global."""
    from eddyline.operators.prefix import assign_buckets

    epoch = 1_700_000_000_000
    ts = F.when(F.col("id") == 0, F.lit(0)).otherwise(F.lit(epoch) + F.col("id"))
    df = spark.range(40_000).select(F.lit("hot").alias("k"), ts.alias("ts"), F.col("id").alias("v")).repartition(4)
    for keys in (["k"], []):
        b = assign_buckets(df, keys, ["ts"])
        sizes = [r["count"] for r in b.df.groupBy("_b").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2 * 10_000, sizes


def test_ties_of_the_first_ordering_column_are_split_by_the_others(spark):
    from eddyline.operators.prefix import assign_buckets

    df = spark.range(8_000).select(F.lit(5).alias("ts"), F.col("id").alias("seq"))
    sizes = [r["count"] for r in assign_buckets(df, [], ["ts", "seq"]).df.groupBy("_b").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 4_000


def test_one_job_places_the_boundaries(spark):
    """Building the plan of a scan starts the sample's job and no other."""
    tracker = spark.sparkContext.statusTracker()
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "value")
    spark.sparkContext.setJobGroup("bounds", "boundaries")
    try:
        running(ev, ["user_id"], ["event_id"], [Running("s", "sum", "value")], hot_rows=20)
        # under adaptive execution a query's stages count as jobs: the sample's shuffle, its result
        assert len(tracker.getJobIdsForGroup("bounds")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_whole_key_values_beside_each_row(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", (F.col("user_id") % 2).alias("k"), "value")
    specs = [Running("mx", "max", "value", whole=True), Running("l", "last", "value", whole=True), Running("n", "count", F.lit(1), whole=True)]
    w = Window.partitionBy("k")
    last = F.last("value").over(w.orderBy("event_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    want = ev.select("*", F.max("value").over(w).alias("mx"), last.alias("l"), F.count(F.lit(1)).over(w).alias("n"))
    for hot_rows in (None, 40):
        got = running(ev, ["k"], ["event_id"], specs, hot_rows=hot_rows)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_prefix_null_keys_empty_input_and_hot_null_key(spark):
    rows = [(i, None if i % 2 else "k", float(i)) for i in range(1, 21)]
    df = spark.createDataFrame(rows, "seq long, key string, v double")
    for hot_rows in (None, 3):
        out = running(df, ["key"], ["seq"], [Running("s", "sum", "v"), Running("n", "count", F.lit(1))], hot_rows=hot_rows)
        got = {r.seq: (r.s, r.n) for r in out.collect()}
        odd = [i for i in range(1, 21) if i % 2]
        even = [i for i in range(1, 21) if not i % 2]
        for grp in (odd, even):
            for j, i in enumerate(grp):
                assert got[i] == (float(sum(grp[: j + 1])), j + 1)
    empty = df.filter("false")
    assert running(empty, ["key"], ["seq"], [Running("s", "sum", "v")]).count() == 0
    assert running(empty, [], ["seq"], [Running("s", "max", "v")], inclusive=False).count() == 0


def test_skewed_key_is_detected_and_split(spark):
    """One key holding a third of the rows is found without any override, split
    into buckets, and gives the same running values as a single-task window."""
    from eddyline.operators.prefix import assign_buckets

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    skewed = ev.select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id").cast("string")).alias("id"),
        F.col("value").alias("vc"),
    )
    b = assign_buckets(skewed, ["id"], ["seq"])
    assert b.any_hot
    buckets = {r["_b"] for r in b.df.filter("id = 'hot'").select("_b").distinct().collect()}
    assert len(buckets) >= 2  # 334 rows > 1000 / 4 per task share
    assert b.df.filter("id != 'hot'").filter("_hot").count() == 0
    got = running(skewed, ["id"], ["seq"], [Running("s", "sum", "vc"), Running("m", "max", "vc")])
    w = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    exp = skewed.select("*", F.sum("vc").over(w).alias("s"), F.max("vc").over(w).alias("m"))
    g, e = got.withColumn("s", F.round("s", 2)), exp.withColumn("s", F.round("s", 2))
    assert g.exceptAll(e).count() == 0 and e.exceptAll(g).count() == 0


def test_hot_key_buckets_hold_equal_counts_when_values_bunch(spark):
    """seq = i^2: equal value ranges would give the first of 4 buckets half the rows;
    the histogram split gives each about a quarter, with the same results."""
    from eddyline.operators.prefix import assign_buckets

    rows = [(i * i, "hot", float(i)) for i in range(400)] + [(10**7 + i, f"c{i}", 1.0) for i in range(4)]
    df = spark.createDataFrame(rows, "seq long, id string, vc double")
    b = assign_buckets(df, ["id"], ["seq"])
    sizes = sorted(r["count"] for r in b.df.filter("id = 'hot'").groupBy("_b").count().collect())
    assert len(sizes) == 4 and max(sizes) <= 130, sizes
    got = running(df, ["id"], ["seq"], [Running("s", "sum", "vc"), Running("f", "first", "seq")])
    w = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("*", F.sum("vc").over(w).alias("s"), F.first("seq").over(w).alias("f"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_boundary_sample_does_not_grow_with_the_tasks(spark):
    """8 or 500 tasks: the rows that meet in one place are bounded, and the parts stay about equal."""
    from eddyline.operators import prefix
    from eddyline.session import target_parallelism

    sizes, widest, width = {}, {}, target_parallelism(spark)
    for tasks in (8, 500):
        df = spark.range(200_000, numPartitions=tasks).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("k"))
        b = prefix.assign_buckets(df, [], ["seq"])
        counts = [r["count"] for r in b.df.groupBy("_b").count().collect()]
        assert len(counts) == width
        widest[tasks] = max(counts) / (200_000 / width)
        sizes[tasks] = prefix._sample(df, ["k"], ["seq"]).count()
    assert max(sizes.values()) <= prefix.POINTS * width and max(widest.values()) < 2


def test_boundary_sample_is_merged_in_a_tree(spark, monkeypatch):
    """Small groups of tasks force every merge; weights still add up to the rows."""
    from eddyline.operators import prefix
    from eddyline.session import target_parallelism

    width = target_parallelism(spark)
    monkeypatch.setattr(prefix, "FAN", 4)
    monkeypatch.setattr(prefix, "SIZE_MARGIN", 1 << 40)
    df = spark.range(100_000, numPartitions=64).select(F.col("id").alias("seq"), F.when(F.col("id") % 10 < 4, 7).otherwise(F.col("id")).alias("k"))
    assert prefix._groupings(df) == 2
    rows = prefix._sample(df, ["k"], ["seq"]).collect()
    total = sum(r["_w"] for r in rows)
    assert len(rows) <= prefix.POINTS * width and 0.7 < total / 100_000 < 1.4
    assert 0.3 < sum(r["_w"] for r in rows if r["_k0"] == 7) / total < 0.5
    b = prefix.assign_buckets(df, ["k"], ["seq"])
    hot = [r["count"] for r in b.df.where("k = 7").groupBy("_b").count().collect()]
    assert b.any_hot and len(hot) > 1 and max(hot) < 2 * 100_000 / width


def test_large_inputs_are_dealt_to_more_parts(spark, monkeypatch):
    """More parts than shuffle partitions where a task would sort too many rows; buckets are found without
    higher-order functions, which Spark does not compile; the results are those of one scan."""
    from eddyline.operators import prefix

    monkeypatch.setattr(prefix, "ROWS_A_TASK", 50)
    rows = [(i // 7, i % 7, "a" if i % 3 else None if i % 5 == 0 else f"k{i % 40}") for i in range(900)]
    df = spark.createDataFrame(rows, "a long, b long, key string").repartition(3)
    cut = prefix.assign_buckets(df, ["key"], ["a", "b"])
    assert 4 < cut.parts < 40 and cut.any_hot
    assert 1 < cut.df.where("key = 'a'").select("_b").distinct().count() <= 4
    specs = [prefix.Running("n", "count", F.lit(1)), prefix.Running("prev", "last", "b", whole=False)]
    out = prefix.running(df, ["key"], ["a", "b"], specs)
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    seen, want = {}, []
    for a, b, key in rows:
        seen[key] = seen.get(key, 0) + 1
        want.append((a, b, key, seen[key], b))
    assert sorted(map(tuple, out.collect())) == want
