"""The sink with a commit protocol: failed tasks, replayed epochs and broken commits leave each row once."""

import glob
import os
import time

import pytest

from eddyline._ship import ship_by_value
from eddyline.sinks.committing import ParquetStage, read_committed, register_sink
from eddyline.sources.lines import read_lines
from eddyline.streaming.run import checkpoint_location

ship_by_value(__name__)  # the sinks below run inside tasks


class FailsOnce(ParquetStage):
    """Writes some rows, then fails, as long as the flag file is there."""

    def __init__(self, path, flag):
        super().__init__(path, rows_per_group=1)
        self.flag = flag

    def stage(self, rows, schema):
        def until_it_breaks():
            for k, row in enumerate(rows):
                if k and os.path.exists(self.flag):
                    raise RuntimeError("this task breaks")
                yield row

        return super().stage(until_it_breaks(), schema)


def lines_of(spark, path, schema):
    return sorted(r.value for r in read_committed(spark, path, schema).collect())


def write_files(folder, chunks):
    now = time.time() - 1000
    for i, lines in enumerate(chunks):
        path = os.path.join(folder, f"part{i}.txt")
        with open(path, "w") as f:
            f.write("\n".join(lines))
        os.utime(path, (now + i, now + i))


def test_batch_commit_and_replay(spark, tmp_path):
    path = str(tmp_path / "out")
    register_sink(spark, "staged_batch", lambda options: ParquetStage(options["path"]))
    df = spark.createDataFrame([(k, f"v{k}", None if k % 3 else [k]) for k in range(50)], "k long, v string, a array<long>").repartition(4)
    for _ in range(2):  # the same epoch again: nothing is doubled
        df.write.format("staged_batch").option("path", path).option("epoch", "day1").mode("append").save()
    df.where("k < 5").write.format("staged_batch").option("path", path).mode("append").save()
    assert read_committed(spark, path, df.schema).count() == 55
    assert glob.glob(f"{path}/_staging/*") == []
    got = read_committed(spark, path, df.schema).where("k = 3").collect()
    assert [(r.v, r.a) for r in got] == [("v3", [3])] * 2
    assert read_committed(spark, str(tmp_path / "none"), df.schema).count() == 0


def test_failed_task_and_replayed_epoch_leave_each_row_once(spark, tmp_path):
    folder, path, flag = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "flag")
    folder.mkdir()
    write_files(folder, [["a", "b", "c"], ["d", "e"], ["f"]])
    register_sink(spark, "staged_stream", lambda options: FailsOnce(options["path"], options["flag"]))
    ck = checkpoint_location(spark, "staged")
    lines = read_lines(spark, str(folder), "streaming", max_files_per_trigger=1).coalesce(1)

    def run():
        q = lines.writeStream.format("staged_stream").option("path", path).option("flag", flag)
        q = q.option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()

    open(flag, "w").close()
    with pytest.raises(Exception, match="breaks"):
        run()
    assert lines_of(spark, path, lines.schema) == []
    os.remove(flag)
    run()
    assert lines_of(spark, path, lines.schema) == list("abcdef")
    # Spark lost the note that the last epoch is done: it runs again
    local = ck.removeprefix("file:")
    for note in ("2", ".2.crc"):
        os.remove(f"{local}/commits/{note}")
    run()
    assert lines_of(spark, path, lines.schema) == list("abcdef")


def test_a_commit_without_its_marker_is_not_seen(spark, tmp_path):
    from pyspark.sql import Row
    from pyspark.sql import types as T

    path, schema = str(tmp_path / "out"), T.StructType([T.StructField("value", T.StringType())])
    sink = ParquetStage(path)
    first = sink.stage(iter([Row(value="x")]), schema)
    os.makedirs(f"{path}/epoch=7")
    os.rename(f"{path}/_staging/{first}", f"{path}/epoch=7/part-00000.parquet")  # as a driver lost in between leaves it
    assert lines_of(spark, path, schema) == []
    again = sink.stage(iter([Row(value="x"), Row(value="y")]), schema)
    sink.commit([again], "7")
    assert lines_of(spark, path, schema) == ["x", "y"]
    assert sink.stage(iter([]), schema) is None
    late = sink.stage(iter([Row(value="z")]), schema)
    sink.abort([late], "8")
    assert glob.glob(f"{path}/_staging/*") == [] and sink.epochs() == ["7"]
