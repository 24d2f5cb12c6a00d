import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from eddyline.session import build_session

    s = build_session("local[4]", shuffle_partitions=4, app="eddyline-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture
def sensors(spark):
    """The sensor file as (seq, id, ts, vc), seq = line number (1-based)."""
    from pyspark.sql import functions as F

    from eddyline.functions.text import parse_sensor

    lines = spark.read.text(os.path.join(FIXTURES, "sensor.txt"))
    lines = lines.withColumn("seq", F.monotonically_increasing_id() + 1).coalesce(1)
    parsed, _ = parse_sensor(lines, keep=("seq",))
    return parsed
