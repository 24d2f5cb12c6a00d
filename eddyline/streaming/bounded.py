"""User triggers, evictors and window functions on bounded tables: the stream's own processors.

``run_bounded`` runs stateful stream code over a table as one bounded stream and ends it with a final
watermark, as the end of a bounded input does: the table is written once below the shared
checkpoint folder with one end row of a far time behind it, and the stream over both runs until
nothing is left. The end row moves the watermark only; it is filtered out before the processors.
All timers fire, and the result is a table again. So one class serves both modes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.session import shared_path
from eddyline.streaming.run import checkpoint_location, foreach_batch_available
from eddyline.streaming.stateful import use_rocksdb

END_OF_TIME = "9000-01-01 00:00:00"


def run_bounded(df: DataFrame, ts: str, build: Callable[[DataFrame], DataFrame], bound: str = "0 seconds") -> DataFrame:
    """The rows that ``build(stream)`` emits for the bounded table ``df``, whose time column ``ts`` gets a
    watermark ``bound`` behind. ``build`` is what a stream would get: usually ``groupBy(...)
    .transformWithState(processor, schema, "Update", "EventTime")``. Rows without a time come to
    no window and are left out."""
    if df.isStreaming:
        raise ValueError("a stream ends when it is stopped: apply the processor to it directly")
    spark = df.sparkSession
    use_rocksdb(spark)
    base = shared_path(spark, "bounded", uuid.uuid4().hex)
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = df.where(F.col(ts).isNotNull())
    rows.write.parquet(f"{base}/in")
    end = [F.lit(END_OF_TIME if f.name == ts else None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    spark.range(1).select(*end).write.mode("append").parquet(f"{base}/in")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    stream = spark.readStream.schema(schema).parquet(f"{base}/in").withWatermark(ts, bound)
    # the filter looks at the time column, so it stays above the watermark
    out = build(stream.where(F.col(ts) < F.lit(END_OF_TIME).cast("timestamp")))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    foreach_batch_available(out, keep, "bounded", checkpoint_location(spark, "bounded"), output_mode="update")
    found = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema.fields]).add("batch_id", "long")
    return spark.read.option("basePath", f"{base}/out").schema(found).parquet(f"{base}/out").drop("batch_id")
