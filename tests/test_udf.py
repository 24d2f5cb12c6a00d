"""Python reducers and aggregate functions over Spark partitions."""

from pyspark.sql import functions as F

from eddyline.operators import keyed
from eddyline.operators.udaf import AverageFunction, CountFunction, aggregate
from eddyline.operators.udf_reduce import rolling_reduce_fn
from eddyline._ship import ship_by_value
from tests.conftest import SF_SMALL

ship_by_value(__name__)  # the reducer below runs inside tasks


def reference_reducer(a, b):
    """id of the left, ts of the newer, max vc (associative)."""
    return {"ts": b["ts"], "vc": max(a["vc"], b["vc"])}


def test_reduce_fn_on_fixture(sensors):
    out = rolling_reduce_fn(sensors, "id", "seq", ["ts", "vc"], reference_reducer)
    got = [(r.ts, r.vc) for r in out.filter("id = 'sensor_1'").orderBy("seq").collect()]
    assert got == [(1547718199, 35.8), (1547718207, 36.3), (1547718209, 36.3), (1547718212, 37.1)]


def test_reduce_fn_hot_split_equals_builtin(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("event_id").alias("seq"), (F.col("user_id") % 2).cast("string").alias("id"), "ts", F.col("value").alias("vc")
    )
    got = rolling_reduce_fn(ev, "id", "seq", ["ts", "vc"], reference_reducer, hot_rows=40)
    exp = keyed.keyed_reduce_latest_max(ev, "id", "vc", "seq", latest=("ts",))
    assert got.count() == 1000
    assert got.exceptAll(exp.select("seq", "id", "ts", "vc")).count() == 0


def test_aggregate_function_two_phase(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5)
    avg = aggregate(ev, ["user_id"], "value", AverageFunction(), "double", "avg_v")
    exp = ev.groupBy("user_id").agg(F.avg("value").alias("e"))
    j = avg.join(exp, "user_id")
    assert j.count() == exp.count()
    assert j.filter(F.abs(F.col("avg_v") - F.col("e")) > 1e-9).count() == 0
    cnt = aggregate(ev, ["event_type"], "value", CountFunction(), "long", "n", max_keys_per_flush=2)
    assert {r.event_type: r.n for r in cnt.collect()} == {r.event_type: r["count"] for r in ev.groupBy("event_type").count().collect()}


def test_python_folds_across_tiny_arrow_batches(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("id"), "ts", F.col("value").alias("vc")
    )
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = rolling_reduce_fn(ev, "id", "seq", ["ts", "vc"], reference_reducer)
        exp = keyed.keyed_reduce_latest_max(ev, "id", "vc", "seq", latest=("ts",))
        assert got.exceptAll(exp.select("seq", "id", "ts", "vc")).count() == 0 and got.count() == 1000
        avg = aggregate(ev, ["id"], "vc", AverageFunction(), "double", "a")
        ref = ev.groupBy("id").agg(F.avg("vc").alias("e"))
        j = avg.join(ref, "id")
        assert j.count() == ref.count() == avg.count()
        assert j.filter(F.abs(F.col("a") - F.col("e")) > 1e-9).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_a_task_holds_a_bounded_number_of_accumulators(spark):
    """Twice 40,000 keys in one task: far fewer are held, so both halves give an accumulator for each,
    and the results are those of the whole."""
    from eddyline.operators import udaf

    rows = spark.range(0, 80_000, 1, 1).selectExpr("id % 40000 AS k", "id AS v")
    assert udaf.KEYS_HELD < 40_000
    assert udaf.partials(rows, ["k"], "v", udaf.CountFunction()).count() == 80_000
    out = udaf.aggregate(rows, ["k"], "v", udaf.CountFunction(), "long", "n")
    assert [tuple(r) for r in out.groupBy("n").count().collect()] == [(2, 40_000)]
