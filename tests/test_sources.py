"""Line sources and in-memory rows."""

import os

import pytest

from eddyline.sources.collection import from_rows
from eddyline.sources.lines import encode_kafka_value, read_lines
from eddyline.sources.tables import document_lines, sensor_lines, sensor_view
from tests.conftest import FIXTURES, SF_SMALL


def test_read_lines_modes(spark):
    path = os.path.join(FIXTURES, "hello.txt")
    assert read_lines(spark, path, "batch").count() == 4
    assert read_lines(spark, path, "automatic").count() == 4  # a path is bounded: batch
    assert read_lines(spark, FIXTURES, "streaming").isStreaming
    with pytest.raises(ValueError):
        read_lines(spark, path, "bounded")


def test_collection_keeps_duplicates_and_schema(spark):
    df = from_rows(spark, [("21", 1212, 12.1)] * 3)
    assert [f.name for f in df.schema.fields] == ["id", "ts", "vc"] and df.count() == 3


def test_table_views(spark):
    sv = sensor_view(spark, SF_SMALL)
    assert sv.columns == ["seq", "id", "ts", "vc", "event_type"] and sv.count() == 1000
    first = sensor_lines(spark, SF_SMALL).orderBy("seq").first()
    assert first.value.count(",") == 2
    lines = document_lines(spark, SF_SMALL)
    assert lines.columns == ["doc_id", "line_no", "value"] and lines.count() > 200


def test_kafka_value_encoding(spark):
    df = spark.createDataFrame([("a,1,2.0",)], "line string")
    row = encode_kafka_value(df, "line", "test").first()
    assert bytes(row.value).decode() == "a,1,2.0" and row.topic == "test"


def test_streaming_a_file_reads_that_file_only(spark, tmp_path):
    from eddyline.streaming.run import run_available

    for name, text in (("a[1].txt", "x\ny"), ("a1.txt", "z"), ("b.txt", "p\nq\nr")):
        (tmp_path / name).write_text(text)
    stream = read_lines(spark, str(tmp_path / "a[1].txt"), "streaming")
    assert sorted(r.value for r in run_available(stream, "onefile").collect()) == ["x", "y"]
    (tmp_path / "all").mkdir()
    for name in ("a.txt", "b.txt"):
        (tmp_path / "all" / name).write_text("x\ny")
    assert run_available(read_lines(spark, str(tmp_path / "all"), "streaming"), "folder").count() == 4


def test_a_cluster_needs_a_shared_checkpoint_folder(monkeypatch):
    from types import SimpleNamespace

    from eddyline import session

    conf = SimpleNamespace(get=lambda name, default=None: default)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))
