"""Process functions: rows per element, lifecycle, side outputs, on tables and streams."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from eddyline._ship import ship_by_value
from eddyline.functions.text import java_split
from eddyline.operators.process import ProcessFunction, process
from eddyline.operators.process_fns import AlertFunction, SplitFunction
from eddyline.session import materialize
from eddyline.sources.lines import read_lines
from eddyline.streaming.run import run_available

ship_by_value(__name__)  # the functions below run inside tasks


class Numbered(ProcessFunction):
    """The element's number in its task, as often as its value says; the rest to a side output."""

    def open(self, ctx):
        self.seen, self.task, self.closed = 0, ctx.partition, False

    def process_element(self, element, ctx):
        assert not self.closed
        self.seen += 1
        if element["n"] is None or element["n"] < 0:
            ctx.output("odd", element["k"], None if element["n"] is None else [element["n"]])
            return
        for i in range(element["n"]):
            yield element["k"], i, self.seen, self.task

    def close(self):
        self.closed = True


MAIN, ODD = "k string, i int, seen int, task int", "k string, n array<int>"


def test_rows_per_element_and_side_output(spark):
    df = spark.createDataFrame([("a", 2), ("b", 0), ("c", None), ("d", -1), ("e", 3)], "k string, n int").repartition(2)
    out = process(df, Numbered, MAIN, {"odd": ODD})
    tagged = materialize(out.tagged)
    out.tagged = tagged
    assert sorted((r.k, r.i) for r in out.main.collect()) == [("a", 0), ("a", 1), ("e", 0), ("e", 1), ("e", 2)]
    assert sorted((r.k, r.n) for r in out.side("odd").collect()) == [("c", None), ("d", [-1])]
    assert max(r.seen for r in out.main.collect()) <= 5 and {r.task for r in out.main.collect()} <= {0, 1}
    assert process(df.limit(0), Numbered, MAIN, {"odd": ODD}).main.collect() == []
    with pytest.raises(ValueError, match="main"):
        process(df, Numbered, MAIN, {"main": ODD})


def test_same_class_on_a_stream(spark, tmp_path):
    now = time.time() - 1000
    for i, lines in enumerate([["a,b,,", "", ","], ["x", "p,,q"]]):
        path = tmp_path / f"part{i}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (now + i, now + i))
    lines = lambda mode: read_lines(spark, str(tmp_path), mode, **({"max_files_per_trigger": 1} if mode == "streaming" else {}))
    make = lambda: SplitFunction((), ",")
    batch = process(lines("batch"), make, "pos int, part string").main
    stream = run_available(process(lines("streaming"), make, "pos int, part string").main, "proc")
    built_in = lines("batch").select(F.posexplode(java_split("value", ",")))
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, stream.collect())) == sorted(map(tuple, built_in.collect()))


def test_alerts_carry_the_event_time(spark):
    t = dt.datetime(2024, 1, 1, 3)
    df = spark.createDataFrame([(1, "a", t, 70.0), (2, "a", t, 10.0), (3, None, None, None)], "seq long, id string, ts timestamp_ntz, vc double")
    out = process(df, lambda: AlertFunction(60.0), "seq long, id string, vc double", {"alerts": "seq long, id string, excess double, ts timestamp_ntz"}, ts="ts")
    assert [tuple(r) for r in out.side("alerts").collect()] == [(1, "a", 10.0, t)]
    assert sorted(r.seq for r in out.main.collect()) == [1, 2, 3]
