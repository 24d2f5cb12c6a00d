"""A custom sink with a commit protocol, through Spark's Python data source API.

Tasks stage what they write and report it; the driver commits an epoch (a micro-batch, or a batch
write) as a whole, or aborts it. A failed task's stage is never committed, and a replayed epoch
replaces nothing that has been committed, so every row is there once. ``StagedSink`` is the protocol
a user class follows; ``ParquetStage`` follows it over files of any store that pyarrow reaches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


class StagedSink:
    """``stage`` runs in the tasks, the others on the driver. ``commit`` may be asked again for an
    epoch that it has committed (with what the replay staged) and must then keep the first."""

    def stage(self, rows: Iterator[Row], schema: StructType) -> str | None:
        """Write a task's rows where no reader sees them; returns a handle (None: nothing written)."""
        raise NotImplementedError

    def commit(self, handles: list[str], epoch: str) -> None:
        raise NotImplementedError

    def abort(self, handles: list[str], epoch: str) -> None:
        pass


class ParquetStage(StagedSink):
    """Staged files below ``path``: committing moves them to ``epoch=<n>`` and then writes the epoch's
    marker, and ``read_committed`` reads epochs with a marker only."""

    def __init__(self, path: str, rows_per_group: int = 10_000):
        self.path, self.rows = path, rows_per_group

    def _at(self, *parts: str):
        store, base = pafs.FileSystem.from_uri(self.path)
        return store, "/".join([base.rstrip("/"), *parts])

    def stage(self, rows: Iterator[Row], schema: StructType) -> str | None:
        arrow, writer, held = to_arrow_schema(schema), None, []
        name = f"{uuid.uuid4().hex}.parquet"
        store, file = self._at("_staging", name)

        def flush() -> None:
            nonlocal writer
            if writer is None:
                store.create_dir(file.rsplit("/", 1)[0], recursive=True)
                writer = pq.ParquetWriter(file, arrow, filesystem=store)
            columns = zip(*held)
            writer.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow))
            held.clear()

        try:
            for row in rows:
                held.append(tuple(row))
                if len(held) >= self.rows:
                    flush()
            if held:
                flush()
        finally:
            if writer is not None:
                writer.close()
        return name if writer is not None else None

    def commit(self, handles: list[str], epoch: str) -> None:
        store, marker = self._at("_epochs", epoch)
        if store.get_file_info(marker).type == pafs.FileType.File:
            return self.abort(handles, epoch)
        folder = self._at(f"epoch={epoch}")[1]
        if store.get_file_info(folder).type == pafs.FileType.Directory:
            store.delete_dir_contents(folder)  # of a commit that did not come to its marker
        store.create_dir(folder, recursive=True)
        for k, name in enumerate(sorted(handles)):
            store.move(self._at("_staging", name)[1], f"{folder}/part-{k:05d}.parquet")
        store.create_dir(marker.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(marker) as out:
            out.write(str(len(handles)).encode())

    def abort(self, handles: list[str], epoch: str) -> None:
        for name in handles:
            store, file = self._at("_staging", name)
            if store.get_file_info(file).type == pafs.FileType.File:
                store.delete_file(file)

    def epochs(self) -> list[str]:
        store, folder = self._at("_epochs")
        found = store.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == pafs.FileType.File)


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all committed epochs."""
    paths = [f"{path.rstrip('/')}/epoch={e}" for e in ParquetStage(path).epochs()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


@dataclass
class Staged(WriterCommitMessage):
    handle: str | None


def _handles(messages: list) -> list[str]:
    return [m.handle for m in messages if m is not None and m.handle is not None]


class _Writer:
    def __init__(self, sink: StagedSink, schema: StructType):
        self.sink, self.schema = sink, schema

    def write(self, iterator: Iterator[Row]) -> Staged:
        return Staged(self.sink.stage(iterator, self.schema))


class _BatchWriter(_Writer, DataSourceWriter):
    def __init__(self, sink, schema, epoch):
        super().__init__(sink, schema)
        self.epoch = epoch

    def commit(self, messages: list) -> None:
        self.sink.commit(_handles(messages), self.epoch)

    def abort(self, messages: list) -> None:
        self.sink.abort(_handles(messages), self.epoch)


class _StreamWriter(_Writer, DataSourceStreamWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.sink.commit(_handles(messages), str(batchId))

    def abort(self, messages: list, batchId: int) -> None:
        self.sink.abort(_handles(messages), str(batchId))


def register_sink(spark: SparkSession, name: str, factory: Callable[[dict], StagedSink]) -> str:
    """Make ``format(name)`` write through the sink that ``factory(options)`` makes, on tables
    (``option("epoch", ...)`` names the write; a new name by default) and on streams."""

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return _BatchWriter(factory(dict(self.options)), schema, self.options.get("epoch") or uuid.uuid4().hex)

        def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
            return _StreamWriter(factory(dict(self.options)), schema)

    spark.dataSource.register(Source)
    return name


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
