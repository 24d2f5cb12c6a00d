"""Writers for batch DataFrames and for ``foreachBatch`` on streams."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from eddyline.fixed import PRINT_LABEL_FORMAT
from eddyline.streaming.run import checkpoint_location


# ---------------------------------------------------------------- print (O1, O2)


def row_text(df: DataFrame) -> Column:
    """A row as the reference prints records: ``(a,b,...)``."""
    return F.concat(F.lit("("), F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]), F.lit(")"))


def labeled(df: DataFrame, label: str | None = None, text: Column | None = None) -> DataFrame:
    """``print(label)``: one text line per row, prefixed ``label> `` when given."""
    t = text if text is not None else row_text(df)
    return df.select((F.format_string(PRINT_LABEL_FORMAT, F.lit(label), t) if label else t).alias("line"))


def _print_lines(lines: Iterator[str]) -> None:
    for line in lines:
        print(line, flush=True)


def print_rows(
    df: DataFrame,
    label: str | None = None,
    text: Column | None = None,
    out: Callable[[Iterator[str]], None] = _print_lines,
    checkpoint: str | None = None,
):
    """Print every row, from the tasks that hold them (to their standard output, or to
    ``out(lines)``). Batch: returns the number of rows; stream: starts and returns the query, whose
    checkpoint lies below the cluster's shared folder unless one is given."""
    if df.isStreaming:
        writer = df.writeStream.foreachBatch(lambda batch, _: print_rows(batch, label, text, out))
        return writer.option("checkpointLocation", checkpoint or checkpoint_location(df.sparkSession, "print")).start()
    printed = df.sparkSession.sparkContext.accumulator(0)

    def part(rows: Iterator[Row]) -> None:
        n = 0

        def lines() -> Iterator[str]:
            nonlocal n
            for r in rows:
                n += 1
                yield r.line

        out(lines())
        printed.add(n)

    labeled(df, label, text).foreachPartition(part)
    return printed.value


# ---------------------------------------------------------------- last record per key


def latest_per_key(df: DataFrame, key: str, order: str, fields: tuple[str, ...]) -> DataFrame:
    """The newest record of each key (partial aggregation, no sort): what an
    upsert sink keeps after all writes, so writing only it gives the same table."""
    packed = F.max(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in fields])).alias("_m")
    return df.groupBy(key).agg(packed).select(key, *[F.col(f"_m.{c}").alias(c) for c in fields])


def _batched(it: Iterable[Any], size: int) -> Iterator[list]:
    buf = []
    for x in it:
        buf.append(x)
        if len(buf) >= size:
            yield buf
            buf = []
    if buf:
        yield buf


# ---------------------------------------------------------------- hash upsert


class HashClient(Protocol):
    def hset_many(self, name: str, mapping: dict[str, str]) -> None: ...
    def close(self) -> None: ...


def write_hash(df: DataFrame, client_factory: Callable[[], HashClient], name: str, key: str, value: str, batch_size: int = 1000) -> None:
    """``HSET name key value`` for every row, batched per partition; last write wins.
    Call on ``latest_per_key`` output so a key is written once per batch."""
    rows = df.select(F.col(key).cast("string").alias("k"), F.col(value).cast("string").alias("v"))

    def part(it: Iterator[Row]) -> None:
        client = client_factory()
        try:
            for chunk in _batched(it, batch_size):
                client.hset_many(name, {r.k: r.v for r in chunk})
        finally:
            client.close()

    rows.foreachPartition(part)


def hash_batches(client_factory: Callable[[], HashClient], name: str, key: str, value: str, order: str, batch_size: int = 1000):
    """A ``foreachBatch`` function: the last value per key of the micro-batch is upserted. A
    replayed batch writes the same values again."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        write_hash(latest_per_key(batch, key, order, (value,)), client_factory, name, key, value, batch_size)

    return fn


# ---------------------------------------------------------------- index append


class IndexClient(Protocol):
    def bulk(self, index: str, docs: list[tuple[str | None, str]]) -> None: ...
    def close(self) -> None: ...


def write_index(
    df: DataFrame,
    client_factory: Callable[[], IndexClient],
    index: str,
    doc: Column,
    doc_id: Column | None = None,
    bulk_size: int = 1000,
) -> None:
    """Append JSON documents to an index in bulk requests. Without ``doc_id`` a
    replay appends duplicates (as the reference does); a deterministic ``doc_id``
    (e.g. from key and sequence) makes replays overwrite instead."""
    rows = df.select((doc_id.cast("string") if doc_id is not None else F.lit(None).cast("string")).alias("i"), doc.alias("d"))

    def part(it: Iterator[Row]) -> None:
        client = client_factory()
        try:
            for chunk in _batched(it, bulk_size):
                client.bulk(index, [(r.i, r.d) for r in chunk])
        finally:
            client.close()

    rows.foreachPartition(part)


def index_batches(client_factory: Callable[[], IndexClient], index: str, doc: Column, doc_id: Column, bulk_size: int = 1000):
    """A ``foreachBatch`` function: every row becomes a document under its ``doc_id`` (unique per
    row, from the row alone), so a replayed batch overwrites what it wrote before."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        write_index(batch, client_factory, index, doc, doc_id, bulk_size)

    return fn


# ---------------------------------------------------------------- JDBC upsert

DIALECTS = ("mysql", "postgres", "sqlite")


def upsert_sql(table: str, cols: list[str], key: list[str], dialect: str = "mysql") -> str:
    """``INSERT ... ON DUPLICATE KEY UPDATE`` (MySQL) or ``ON CONFLICT DO UPDATE``."""
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}")
    marks = ", ".join(["%s" if dialect in ("mysql", "postgres") else "?"] * len(cols))
    names = ", ".join(cols)
    upd = [c for c in cols if c not in key]
    if dialect == "mysql":
        sets = ", ".join(f"{c} = VALUES({c})" for c in upd)
        return f"INSERT INTO {table} ({names}) VALUES ({marks}) ON DUPLICATE KEY UPDATE {sets}"
    sets = ", ".join(f"{c} = excluded.{c}" for c in upd)
    return f"INSERT INTO {table} ({names}) VALUES ({marks}) ON CONFLICT ({', '.join(key)}) DO UPDATE SET {sets}"


def write_jdbc_upsert(
    df: DataFrame,
    connect: Callable[[], Any],
    table: str,
    key: list[str],
    dialect: str = "mysql",
    batch_size: int = 1000,
) -> None:
    """Upsert every row through a DB-API connection (``connect()`` runs on the
    executor; credentials come from the caller, never from code), ``executemany``
    per batch, one commit per batch. Spark's JDBC writer has no upsert mode."""
    cols = df.columns
    sql = upsert_sql(table, cols, key, dialect)

    def part(it: Iterator[Row]) -> None:
        conn = connect()
        try:
            cur = conn.cursor()
            for chunk in _batched(it, batch_size):
                cur.executemany(sql, [tuple(r) for r in chunk])
                conn.commit()
        finally:
            conn.close()

    df.foreachPartition(part)


def upsert_batches(connect: Callable[[], Any], table: str, key: str, order: str, fields: tuple[str, ...], dialect: str = "mysql"):
    """A ``foreachBatch`` function: last record per key of the micro-batch, then upsert."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        write_jdbc_upsert(latest_per_key(batch, key, order, fields), connect, table, [key], dialect)

    return fn


# ---------------------------------------------------------------- custom sink


class RichSink:
    """``RichSinkFunction`` for ``writeStream.foreach``: ``open`` once per partition
    and epoch (return False to skip it), ``process`` per row, ``close`` at the end
    (with the error, if any)."""

    def open(self, partition_id: int, epoch_id: int) -> bool:
        return True

    def process(self, row: Row) -> None:
        raise NotImplementedError

    def close(self, error: BaseException | None) -> None:
        pass


def write_foreach_batch(df: DataFrame, sink_factory: Callable[[], RichSink], epoch_id: int = 0) -> None:
    """Drive a ``RichSink`` over a batch DataFrame with the same lifecycle."""
    from pyspark import TaskContext

    def part(it: Iterator[Row]) -> None:
        sink = sink_factory()
        pid = TaskContext.get().partitionId() if TaskContext.get() else 0
        err = None
        try:
            if sink.open(pid, epoch_id):
                for r in it:
                    sink.process(r)
        except BaseException as e:  # noqa: BLE001 - handed to close, then re-raised
            err = e
            raise
        finally:
            sink.close(err)

    df.foreachPartition(part)


def kafka_payload(df: DataFrame, value: Column, topic: str) -> DataFrame:
    """Rows the Kafka sink takes: ``value`` bytes (UTF-8 text) and ``topic``; no key."""
    return df.select(value.cast("string").cast("binary").alias("value"), F.lit(topic).alias("topic"))


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
