"""Line sources: bounded text, a directory as a stream, socket and Kafka options.

``read_lines`` is the runtime-mode switch: the same transformation code runs on
its result whether it is a batch DataFrame or a streaming one.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH, STREAMING, AUTOMATIC = "batch", "streaming", "automatic"


def _is_folder(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system, local or not."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop)
    return bool(status.isDirectory())


def read_lines(spark: SparkSession, path: str, mode: str = AUTOMATIC, max_files_per_trigger: int | None = None) -> DataFrame:
    """One row (``value``) per line of a text file or directory.

    ``batch`` reads it once; ``streaming`` watches the directory (new files become
    micro-batches; a file's path streams that file only); ``automatic`` is batch because a path is a bounded source.
    """
    if mode not in (BATCH, STREAMING, AUTOMATIC):
        raise ValueError(f"mode must be batch, streaming or automatic, not {mode!r}")
    if mode == STREAMING:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        folder, _, name = path.rstrip("/").rpartition("/")
        if not _is_folder(spark, path):  # a stream watches a folder: this file of it only
            reader = reader.option("pathGlobFilter", re.sub(r"([*?\[\]{}\\])", r"\\\1", name))
            path = folder or "."
        return reader.load(path)
    return spark.read.text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """``socketTextStream(host, port)``: not fault tolerant (no replay); for demos.
    Building the DataFrame opens nothing; starting a query connects."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    group_id: str | None = None,
    starting_offsets: str = "latest",
    extra: dict | None = None,
) -> dict:
    """Options of the Kafka source. Spark tracks offsets in its checkpoint, not in
    the consumer group, so ``startingOffsets`` says where a new query begins."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def kafka_lines(spark: SparkSession, options: dict) -> DataFrame:
    """UTF-8 string values of a topic (``SimpleStringSchema``). Needs the Kafka
    connector package on the classpath."""
    return decode_kafka_value(spark.readStream.format("kafka").options(**options).load())


def decode_kafka_value(df: DataFrame) -> DataFrame:
    """bytes -> string for Kafka-shaped rows (``key``/``value`` binary)."""
    return df.select(F.col("value").cast("string").alias("value"))


def encode_kafka_value(df: DataFrame, col: str, topic: str | None = None) -> DataFrame:
    """string -> the ``value`` (and optional ``topic``) columns the Kafka sink expects; no key."""
    cols = [F.col(col).cast("binary").alias("value")]
    if topic:
        cols.append(F.lit(topic).alias("topic"))
    return df.select(*cols)
