"""Late data on event-time windows, batch form (deterministic).

The watermark seen by a row is the running maximum of the event times of all
rows that arrived before it, minus the out-of-orderness bound. That running
maximum is a global ordered prefix: it runs through ``prefix.running`` with no
key, which cuts the arrival order into P ranges scanned in parallel (never one
un-partitioned window over the data).

For a window ``[start, end)`` and a row with watermark ``wm``:
  late      ``end <= wm``
  dropped   ``end + lateness <= wm``   (goes to the side output)
  re-fires  late and not dropped
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.operators.prefix import Running, running
from eddyline.operators.windows import duration_us
from eddyline.session import materialize


def _interval(text: str):
    return F.expr(f"INTERVAL {duration_us(text)} MICROSECONDS")


def classify(
    df: DataFrame,
    ts: str,
    arrival: list[str],
    size: str,
    bound: str,
    lateness: str = "0 seconds",
) -> DataFrame:
    """Add ``win_start``, ``win_end``, ``wm``, ``late`` and ``dropped`` to each row.
    ``arrival`` orders the rows as they arrive (unique)."""
    wm = running(df, [], arrival, [Running("_maxts", "max", F.col(ts))], inclusive=False)
    w = F.window(ts, size)
    out = wm.withColumn("wm", F.col("_maxts") - _interval(bound)).drop("_maxts")
    out = out.withColumn("win_start", w.start).withColumn("win_end", w.end)
    late = F.coalesce(F.col("win_end") <= F.col("wm"), F.lit(False))
    dropped = F.coalesce(F.col("win_end") + _interval(lateness) <= F.col("wm"), F.lit(False))
    return out.withColumn("late", late).withColumn("dropped", dropped)


def on_time_windows(classified: DataFrame, key: str, value: str) -> DataFrame:
    """Firings when the watermark passes the window end: on-time rows only
    (with lateness 0 every late row is dropped)."""
    return (
        classified.filter(~F.col("late"))
        .groupBy(key, "win_start", "win_end")
        .agg(F.sum(value).alias("sum_vc"), F.count(F.lit(1)).alias("cnt"))
    )


def allowed_lateness(classified: DataFrame, key: str, value: str, arrival: list[str]) -> DataFrame:
    """``allowedLateness``: firing 0 is the on-time result; every late row that is
    not dropped fires the window again with the updated result (firing 1, 2, ...).
    A window with no on-time rows has no firing 0.

    The classified rows are written once (a checkpoint), as the second scan reads them twice, for
    its boundaries and for its rows; then one shuffle by (key, window): the prefix scan numbers and
    sums the late rows in arrival order and puts the on-time result beside them; a late row is its
    own firing, and the first on-time row of a window carries firing 0."""
    late, on_time = F.col("late"), ~F.col("late")
    rows = materialize(classified.filter(~F.col("dropped")).select(key, "win_start", value, "late", *arrival))
    run = running(
        rows,
        [key, "win_start"],
        arrival,
        [
            Running("firing", "count", F.when(late, 1)),
            Running("_late_sum", "sum", F.when(late, F.col(value))),
            Running("_rank", "count", F.when(on_time, 1)),
            Running("_on_sum", "sum", F.when(on_time, F.col(value)), whole=True),
            Running("_on_cnt", "count", F.when(on_time, 1), whole=True),
        ],
    )
    fires = run.filter(late | (F.col("_rank") == 1))
    firing = F.when(late, F.col("firing")).otherwise(F.lit(0)).cast("long")
    late_sum = F.when(late, F.coalesce(F.col("_late_sum"), F.lit(0.0))).otherwise(F.lit(0.0))
    return fires.select(
        key,
        "win_start",
        firing.alias("firing"),
        (F.coalesce(F.col("_on_sum"), F.lit(0.0)) + late_sum).alias("sum_vc"),
        (F.col("_on_cnt") + firing).alias("cnt"),
    )


def side_output(classified: DataFrame) -> DataFrame:
    """``sideOutputLateData``: the rows too late to be kept."""
    return classified.filter(F.col("dropped"))
