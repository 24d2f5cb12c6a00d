"""In-memory rows (``fromCollection``): duplicates are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eddyline.schemas import SENSOR


def from_rows(spark: SparkSession, rows, schema=SENSOR) -> DataFrame:
    """A small driver-side collection as a DataFrame (for fixtures and demos; large
    inputs belong in files or tables)."""
    return spark.createDataFrame(list(rows), schema)
