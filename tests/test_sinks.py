"""Sinks: print lines, upserts (hash, JDBC via sqlite), index append, custom writer."""

import os
import sqlite3
import tempfile

from pyspark.sql import functions as F

from eddyline._ship import ship_by_value
from eddyline.functions.text import sensor_to_doc, sensor_to_string
from eddyline.sinks import writers as W
from eddyline.streaming.run import foreach_batch_available

ship_by_value(__name__)  # the test doubles below run inside tasks

EXPECTED = {
    "sensor_1": (1547718212, 37.1),
    "sensor_6": (1547718201, 15.4),
    "sensor_7": (1547718202, 6.7),
    "sensor_10": (1547718205, 38.1),
}


def test_print_label(sensors):
    lines = W.labeled(sensors.filter("seq = 1"), "test", sensor_to_string()).collect()
    assert lines[0].line == "test> WaterSensor{id='sensor_1', ts=1547718199, vc=35.8}"
    plain = W.labeled(sensors.filter("seq = 2").select("id", "vc")).first().line
    assert plain == "(sensor_6,15.4)"


def test_latest_per_key(sensors):
    got = {r.id: (r.ts, r.vc) for r in W.latest_per_key(sensors, "id", "seq", ("ts", "vc")).collect()}
    assert got == EXPECTED


class SqliteHash:
    """Test double of a hash store, backed by a local sqlite file."""

    def __init__(self, path):
        self.conn = sqlite3.connect(path, timeout=30)
        self.conn.execute("CREATE TABLE IF NOT EXISTS h (name TEXT, field TEXT, value TEXT, PRIMARY KEY (name, field))")

    def hset_many(self, name, mapping):
        self.conn.executemany("INSERT OR REPLACE INTO h VALUES (?, ?, ?)", [(name, k, v) for k, v in mapping.items()])
        self.conn.commit()

    def close(self):
        self.conn.close()


def test_hash_upsert(sensors):
    path = os.path.join(tempfile.mkdtemp(prefix="hash-"), "h.db")
    latest = W.latest_per_key(sensors, "id", "seq", ("ts", "vc"))
    W.write_hash(latest, lambda: SqliteHash(path), "Sensor", "id", "vc")
    W.write_hash(latest, lambda: SqliteHash(path), "Sensor", "id", "vc")  # replay: unchanged
    rows = dict(sqlite3.connect(path).execute("SELECT field, value FROM h WHERE name = 'Sensor'").fetchall())
    assert rows == {k: str(v) for k, (_, v) in EXPECTED.items()}


class ListIndex:
    def __init__(self, path):
        self.path = path

    def bulk(self, index, docs):
        with open(self.path, "a") as f:
            for i, d in docs:
                f.write(f"{index}\t{i}\t{d}\n")

    def close(self):
        pass


def test_index_append(sensors):
    d = tempfile.mkdtemp(prefix="index-")
    doc = F.to_json(sensor_to_doc())
    W.write_index(sensors.coalesce(1), lambda: ListIndex(os.path.join(d, "docs.tsv")), "sensor1", doc, bulk_size=3)
    lines = open(os.path.join(d, "docs.tsv")).read().splitlines()
    assert len(lines) == 7
    assert 'sensor1\tNone\t{"ts":"1547718199","vc":"35.8"}' in lines


def _sqlite_table(path):
    conn = sqlite3.connect(path)
    conn.execute("CREATE TABLE sensor (id TEXT PRIMARY KEY, ts INTEGER, vc REAL)")
    conn.commit()
    conn.close()


def test_upsert_sql_dialects():
    assert W.upsert_sql("sensor", ["id", "ts", "vc"], ["id"], "mysql") == (
        "INSERT INTO sensor (id, ts, vc) VALUES (%s, %s, %s) ON DUPLICATE KEY UPDATE ts = VALUES(ts), vc = VALUES(vc)"
    )
    assert "ON CONFLICT (id) DO UPDATE SET ts = excluded.ts" in W.upsert_sql("sensor", ["id", "ts", "vc"], ["id"], "sqlite")


def test_jdbc_upsert_batch_and_stream_replay(spark, sensors):
    path = os.path.join(tempfile.mkdtemp(prefix="jdbc-"), "db.sqlite")
    _sqlite_table(path)
    latest = W.latest_per_key(sensors, "id", "seq", ("ts", "vc"))
    W.write_jdbc_upsert(latest, lambda: sqlite3.connect(path, timeout=30), "sensor", ["id"], "sqlite")
    rows = {r[0]: (r[1], r[2]) for r in sqlite3.connect(path).execute("SELECT * FROM sensor").fetchall()}
    assert rows == EXPECTED
    # as a stream: every micro-batch upserts its last record per key
    d = tempfile.mkdtemp(prefix="jdbc-in-")
    sensors.write.mode("overwrite").parquet(os.path.join(d, "in"))
    stream = spark.readStream.schema(sensors.schema).parquet(os.path.join(d, "in"))
    fn = W.upsert_batches(lambda: sqlite3.connect(path, timeout=30), "sensor", "id", "seq", ("ts", "vc"), "sqlite")
    foreach_batch_available(stream, fn, "jdbc")
    rows = {r[0]: (r[1], r[2]) for r in sqlite3.connect(path).execute("SELECT * FROM sensor").fetchall()}
    assert rows == EXPECTED


class CountingSink(W.RichSink):
    def __init__(self, path):
        self.path = path

    def open(self, partition_id, epoch_id):
        self.conn = sqlite3.connect(self.path, timeout=30)
        self.conn.execute("INSERT INTO life VALUES ('open', NULL)")
        return True

    def process(self, row):
        self.conn.execute("INSERT INTO life VALUES ('row', ?)", (row.id,))

    def close(self, error):
        self.conn.execute("INSERT INTO life VALUES ('close', NULL)")
        self.conn.commit()
        self.conn.close()


def test_custom_sink_lifecycle(spark, sensors):
    path = os.path.join(tempfile.mkdtemp(prefix="life-"), "l.db")
    c = sqlite3.connect(path)
    c.execute("CREATE TABLE life (ev TEXT, id TEXT)")
    c.commit()
    c.close()
    W.write_foreach_batch(sensors.repartition(2), lambda: CountingSink(path))
    evs = [r[0] for r in sqlite3.connect(path).execute("SELECT ev FROM life").fetchall()]
    assert evs.count("row") == 7 and evs.count("open") == evs.count("close") == 2


def test_kafka_payload(sensors):
    from eddyline.functions.text import sensor_to_json

    p = W.kafka_payload(sensors.filter("seq = 1"), sensor_to_json(), "test").first()
    assert p.topic == "test" and bytes(p.value).decode() == '{"id":"sensor_1","ts":1547718199,"vc":35.8}'


def test_print_rows_prints_every_row(spark, tmp_path):
    def to_files(lines):
        got = list(lines)
        if got:
            (tmp_path / f"{abs(hash(got[0]))}.out").write_text("\n".join(got))

    df = spark.range(30).repartition(4)
    assert W.print_rows(df, "n", out=to_files) == 30
    lines = [x for f in tmp_path.glob("*.out") for x in f.read_text().split("\n")]
    assert sorted(lines) == sorted(f"n> ({i})" for i in range(30))


def _sensor_stream(spark, sensors):
    d = tempfile.mkdtemp(prefix="sink-in-")
    sensors.write.mode("overwrite").parquet(os.path.join(d, "in"))
    return spark.readStream.schema(sensors.schema).parquet(os.path.join(d, "in"))


def test_hash_sink_on_a_stream_is_replay_safe(spark, sensors):
    path = os.path.join(tempfile.mkdtemp(prefix="hash-"), "h.db")
    fn = W.hash_batches(lambda: SqliteHash(path), "Sensor", "id", "vc", "seq")
    foreach_batch_available(_sensor_stream(spark, sensors), fn, "hash")
    fn(sensors, 0)  # the batch again
    rows = dict(sqlite3.connect(path).execute("SELECT field, value FROM h WHERE name = 'Sensor'").fetchall())
    assert rows == {k: str(v) for k, (_, v) in EXPECTED.items()}


class SqliteIndex:
    def __init__(self, path):
        self.conn = sqlite3.connect(path, timeout=30)
        self.conn.execute("CREATE TABLE IF NOT EXISTS d (ix TEXT, id TEXT, doc TEXT, PRIMARY KEY (ix, id))")

    def bulk(self, index, docs):
        self.conn.executemany("INSERT OR REPLACE INTO d VALUES (?, ?, ?)", [(index, i, x) for i, x in docs])
        self.conn.commit()

    def close(self):
        self.conn.close()


def test_index_sink_on_a_stream_is_replay_safe(spark, sensors):
    path = os.path.join(tempfile.mkdtemp(prefix="index-"), "d.db")
    fn = W.index_batches(lambda: SqliteIndex(path), "sensor1", F.to_json(sensor_to_doc()), F.concat_ws("-", "id", "seq"))
    foreach_batch_available(_sensor_stream(spark, sensors), fn, "index")
    fn(sensors, 0)
    rows = sqlite3.connect(path).execute("SELECT id, doc FROM d").fetchall()
    assert len(rows) == 7 and ("sensor_1-1", '{"ts":"1547718199","vc":"35.8"}') in rows
