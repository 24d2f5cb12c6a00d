"""Record schemas used across the library."""

from pyspark.sql import types as T

# A sensor reading: id, ts (epoch number, unit chosen by the parser), vc.
SENSOR = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("ts", T.LongType(), True),
        T.StructField("vc", T.DoubleType(), True),
    ]
)
