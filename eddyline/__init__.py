"""eddyline: keyed-stream and window analytics expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` (or a writer) built from
Spark SQL expressions, so the same code runs on bounded tables and on
Structured Streaming sources where Spark allows it.
"""

__version__ = "0.1.0"
