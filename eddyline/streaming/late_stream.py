"""Event-time tumbling windows with allowed lateness and a late side output on a
stream, as a ``foreachBatch`` operator.

Spark's own watermark drops late rows silently (and one batch late), and
``transformWithState`` filters them before user code, so neither can feed a side
output. Here each micro-batch:

1. reads the watermark left by the previous batch (``max ts - bound``; none for
   the first batch), so all rows of a batch see the same watermark;
2. splits its rows: on time (``end > wm``), late but kept (``end + lateness > wm``)
   and dropped (the side output);
3. adds on-time rows to the open windows' partials; every kept late row fires
   its window again with the updated result (firing 1, 2, ... per window, counted
   across batches);
4. advances the watermark; windows whose end it passed fire (firing 0) once;
   windows past ``end + lateness`` are purged from the partials.

The state of a batch (partials of the open windows, and the watermark, written last) is a
version below ``root``, a folder in the shared checkpoint location. A batch starts from the
latest complete version before its own id, so replaying it after a failure rewrites the same
files; a version that is there but cannot be read fails the batch; versions before the one a
replay could need are removed. ``flush`` fires what is still open when a bounded stream ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.operators.prefix import Running, running
from eddyline.operators.windows import duration_us

PARTIAL_SCHEMA = "key string, win_start timestamp, s double, n long, fired boolean, late_firings long"
FIRED_SCHEMA = "key string, win_start timestamp, sum_value double, cnt long, fire_order long, firing long"


def _us_interval(us: int) -> Column:
    return F.expr(f"INTERVAL {us} MICROSECONDS")


class LateWindowOperator:
    def __init__(
        self,
        root: str,
        key: str,
        ts: str,
        value: str,
        order: str,
        size: str,
        bound: str,
        lateness: str = "0 seconds",
    ):
        self.root = root.rstrip("/")
        self.key, self.ts, self.value, self.order = key, ts, value, order
        self.size_us, self.bound_us, self.late_us = duration_us(size), duration_us(bound), duration_us(lateness)
        self.size = size

    # -- versioned state ------------------------------------------------------------
    def _path(self, what: str, batch_id: int) -> str:
        return f"{self.root}/{what}/batch_id={batch_id}"

    def _files(self, spark: SparkSession, path: str):
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop

    def _versions(self, spark: SparkSession) -> list[int]:
        """Complete versions: the watermark is written last."""
        fs, path = self._files(spark, f"{self.root}/watermark")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        ids = [int(n.split("=")[1]) for n in names if n.startswith("batch_id=")]
        return sorted(i for i in ids if fs.exists(self._files(spark, f"{self._path('watermark', i)}/_SUCCESS")[1]))

    def _write(self, df: DataFrame, what: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self._path(what, batch_id))

    def _state(self, spark: SparkSession, before: int) -> tuple[DataFrame, int | None]:
        """(partials, highest event time in microseconds) of the version before a batch."""
        versions = [v for v in self._versions(spark) if v < before]
        if not versions:
            return spark.createDataFrame([], PARTIAL_SCHEMA), None
        held = spark.read.schema("max_us long").parquet(self._path("watermark", versions[-1])).collect()
        return spark.read.schema(PARTIAL_SCHEMA).parquet(self._path("partials", versions[-1])), held[0]["max_us"]

    def _commit(self, spark: SparkSession, partials: DataFrame, max_us: int | None, batch_id: int) -> None:
        self._write(partials, "partials", batch_id)
        self._write(spark.createDataFrame([(max_us,)], "max_us long"), "watermark", batch_id)
        # a replay of this batch needs the version before it, nothing needs older ones
        for old in self._versions(spark)[:-2]:
            for what in ("watermark", "partials"):
                fs, path = self._files(spark, self._path(what, old))
                fs.delete(path, True)

    def _watermark(self, max_us: int | None) -> Column:
        if max_us is None:
            return F.lit(None).cast("timestamp")
        return F.timestamp_micros(F.lit(max_us - self.bound_us))

    # -- one micro-batch ------------------------------------------------------------
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(
            F.col(self.key).cast("string").alias("key"),
            F.col(self.ts).cast("timestamp").alias("ts"),
            F.col(self.value).cast("double").alias("v"),
            F.col(self.order).cast("long").alias("o"),
        ).persist()  # read by the steps below, once from the source
        try:
            self._batch(spark, rows, batch_id)
        finally:
            rows.unpersist()

    def _batch(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> None:
        prev, prev_max = self._state(spark, batch_id)
        wm = self._watermark(prev_max)
        w = F.window("ts", self.size)
        rows = rows.withColumn("win_start", w.start).withColumn("win_end", w.end).withColumn("wm", wm)
        late = F.coalesce(F.col("win_end") <= F.col("wm"), F.lit(False))
        dropped = F.coalesce(F.col("win_end") + _us_interval(self.late_us) <= F.col("wm"), F.lit(False))
        rows = rows.withColumn("late", late).withColumn("dropped", dropped)

        # side output
        self._write(rows.filter("dropped").select("key", "ts", "v", "o"), "late", batch_id)

        # late kept rows re-fire in arrival order, each with the updated window
        kept = rows.filter(F.col("late") & ~F.col("dropped")).select("key", "win_start", "v", "o")
        run = running(kept, ["key", "win_start"], ["o"], [Running("_k", "count", F.lit(1)), Running("_s", "sum", F.col("v"))])
        base = prev.select("key", "win_start", F.col("s").alias("_ps"), F.col("n").alias("_pn"), F.col("late_firings").alias("_pf"))
        refired = run.join(base, ["key", "win_start"], "left").select(
            "key",
            "win_start",
            (F.coalesce("_ps", F.lit(0.0)) + F.col("_s")).alias("sum_value"),
            (F.coalesce("_pn", F.lit(0)) + F.col("_k")).alias("cnt"),
            F.col("o").alias("fire_order"),
            (F.coalesce("_pf", F.lit(0)) + F.col("_k")).alias("firing"),
        )

        # fold this batch's kept rows (on time and late) into the partials
        add = (
            rows.filter(~F.col("dropped"))
            .groupBy("key", "win_start")
            .agg(F.sum("v").alias("_as"), F.count(F.lit(1)).alias("_an"), F.count(F.when(F.col("late"), 1)).alias("_al"))
        )
        merged = prev.join(add, ["key", "win_start"], "full_outer").select(
            "key",
            "win_start",
            (F.coalesce("s", F.lit(0.0)) + F.coalesce("_as", F.lit(0.0))).alias("s"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("_an", F.lit(0))).alias("n"),
            F.coalesce("fired", F.lit(False)).alias("fired"),
            (F.coalesce("late_firings", F.lit(0)) + F.coalesce("_al", F.lit(0))).alias("late_firings"),
        )

        # advance the watermark; fire windows it passed; purge expired ones
        batch_max = rows.agg(F.max(F.unix_micros("ts"))).first()[0]
        new_max = max([x for x in (prev_max, batch_max) if x is not None], default=None)
        new_wm = self._watermark(new_max)
        end = F.col("win_start") + _us_interval(self.size_us)
        # windows already behind the old watermark fired (or were refired) before
        passed_now = F.coalesce(end <= new_wm, F.lit(False)) & ~F.coalesce(end <= wm, F.lit(False))
        due = ~F.col("fired") & passed_now
        self._write(self._on_time(merged.filter(due)).unionByName(refired), "fired", batch_id)
        keep = ~F.coalesce(end + _us_interval(self.late_us) <= new_wm, F.lit(False))
        self._commit(spark, merged.withColumn("fired", F.col("fired") | due).filter(keep), new_max, batch_id)

    @staticmethod
    def _on_time(windows: DataFrame) -> DataFrame:
        return windows.select(
            "key", "win_start", F.col("s").alias("sum_value"), F.col("n").alias("cnt"),
            F.lit(None).cast("long").alias("fire_order"), F.lit(0).cast("long").alias("firing"),
        )

    def flush(self, spark: SparkSession) -> None:
        """The bounded stream has ended: windows that are still open fire (firing 0)."""
        versions = self._versions(spark)
        if not versions:
            return
        number = versions[-1] + 1
        partials, max_us = self._state(spark, number)
        behind = F.coalesce(F.col("win_start") + _us_interval(self.size_us) <= self._watermark(max_us), F.lit(False))
        due = ~F.col("fired") & ~behind
        self._write(self._on_time(partials.filter(due)), "fired", number)
        self._commit(spark, partials.withColumn("fired", F.lit(True)), max_us, number)

    # -- results ------------------------------------------------------------------------
    def fired(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(FIRED_SCHEMA).parquet(f"{self.root}/fired")

    def side_output(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/late")
