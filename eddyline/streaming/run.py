"""Running a streaming DataFrame to completion over the data available now."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.session import shared_path


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A fresh stream checkpoint below the cluster's shared checkpoint folder."""
    return shared_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:8]}")


def run_available(
    df: DataFrame,
    name: str,
    output_mode: str = "append",
    checkpoint: str | None = None,
    flush: list[str] | None = None,
) -> DataFrame:
    """Run ``df`` (streaming) with ``availableNow`` into a memory table and return
    that table as a batch DataFrame (tests and bounded replays).

    ``flush`` (the grouping columns of a windowed aggregate) treats the end of the input as
    the end of the stream: windows that the watermark has not passed are emitted too, as the
    batch form does. The query then runs in update mode, every batch's rows are written below
    the shared checkpoint folder, and the last update of each window is its result. Session
    windows know no update mode: run them with ``output_mode="complete"``, which holds open
    sessions as well."""
    spark = df.sparkSession
    if flush is not None:
        out = checkpoint_location(spark, f"{name}-updates")

        def keep(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        ck = checkpoint or checkpoint_location(spark, name)
        q = df.writeStream.foreachBatch(keep).outputMode("update")
        q = q.option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()
        schema = T.StructType([*df.schema.fields, T.StructField("batch_id", T.LongType())])
        updates = spark.read.option("basePath", out).schema(schema).parquet(out)
        rest = [c for c in df.columns if c not in flush]
        last = F.max_by(F.struct(*rest), "batch_id").alias("_last")
        return updates.groupBy(*flush).agg(last).select(*flush, *[F.col(f"_last.{c}").alias(c) for c in rest])
    table = f"{name}_{uuid.uuid4().hex[:8]}"
    q = (
        df.writeStream.format("memory")
        .queryName(table)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.table(table)


def foreach_batch_available(df: DataFrame, fn, name: str, checkpoint: str | None = None, output_mode: str = "append") -> str:
    """Run ``fn(batch_df, batch_id)`` over every micro-batch available now; returns
    the checkpoint so a restart can resume."""
    spark = df.sparkSession
    ck = checkpoint or checkpoint_location(spark, name)
    q = df.writeStream.foreachBatch(fn).outputMode(output_mode).option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return ck
