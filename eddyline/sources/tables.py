"""The driver's parquet tables and the record views the operators consume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.functions.text import strip_cr, text_lines

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that is narrower than the target parallelism (e.g. one large
    row group) before heavy per-row work; wide scans (the normal case on a
    cluster) are left as they are, so no extra shuffle is added there."""
    from eddyline.session import target_parallelism

    p = target_parallelism(df.sparkSession)
    return df.repartition(p) if df.rdd.getNumPartitions() < p else df


def epoch_millis(ts_col) -> F.Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ, independent of the session zone."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts_col})")


def sensor_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as sensor readings: id = user, seq = arrival position (event_id),
    ts = event time (TIMESTAMP_NTZ), vc = value."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("id"),
        F.col("ts"),
        F.col("value").alias("vc"),
        F.col("event_type"),
    )


def sensor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` rendered as the reference's text lines ``id,ts,vc`` (ts in ms)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.concat_ws(
            ",",
            F.col("user_id").cast("string"),
            epoch_millis("ts").cast("string"),
            F.col("value").cast("string"),
        ).alias("value"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per text line of ``documents``: (doc_id, line_no 0-based, value)."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = docs.select("doc_id", F.posexplode(text_lines("text")).alias("line_no", "value"))
    return lines.select("doc_id", "line_no", strip_cr("value").alias("value"))
