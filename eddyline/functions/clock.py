"""The wall clock as an expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def current_time_millis() -> Column:
    """``System.currentTimeMillis()``: milliseconds since the epoch at which the query (on a stream,
    the micro-batch) started; the same for all its rows."""
    return F.unix_millis(F.current_timestamp())
