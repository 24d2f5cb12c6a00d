"""Helpers shared by the operators: column passing through Arrow, byte columns, hashes."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline._ship import ship_by_value
from eddyline.session import target_parallelism

# Bytes of text handled at once inside a task: bounds the temporaries of a batch,
# whatever number of rows Arrow put into it.
SLICE_BYTES = 4 << 20
# Words whose hash a task remembers; the memory is dropped when it is full.
WORD_CACHE = 150_000


def kept_by_process(key: str, make: Callable):
    """An object that a Python worker keeps for the later tasks it runs (functions are shipped by
    value, so their own module is new in every task)."""
    holder = sys.modules.setdefault("_eddyline_kept", types.ModuleType("_eddyline_kept"))
    if key not in vars(holder):
        vars(holder)[key] = make()
    return vars(holder)[key]


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, filled on first sight."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


# Odd multiplier of the rolling word-window hash.
WINDOW_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Order-sensitive 64-bit hash of every window of ``size`` words."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = word_hashes[:n].copy()
    for k in range(1, size):
        out *= WINDOW_MULTIPLIER
        out += word_hashes[k : k + n]
    return mix64(out)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, vectorised."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(column: pa.Array) -> list[bytes | None]:
    """A string or binary Arrow column as Python bytes, without decoding."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else column.type).to_pylist()


def string_array(values: list[bytes | None]) -> pa.Array:
    """UTF-8 bytes back to an Arrow string column (no copy after the build)."""
    raw = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(raw), raw.buffers(), raw.null_count)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of ``column`` at most
    (one row at least)."""
    if not batch.num_rows:
        return
    ends = np.frombuffer(batch.column(column).buffers()[1], np.int32)
    ends = ends[batch.column(column).offset :][: batch.num_rows + 1].astype(np.int64)
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow``; ``run`` gets batches of a bounded size (``bounded``), whatever the session's
    Arrow settings are, which are left alone."""
    return df.mapInArrow(lambda batches: run(bounded(batches)), schema)


# Rows and bytes of a batch that a task works on at most.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = min(BATCH_ROWS, max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, pa.Array]]],
    new_fields: list[T.StructField],
    by: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add (or replace) columns computed batch by batch in Arrow.

    ``make()`` runs once per task and returns the function that maps a batch to the new
    columns. Every other column of ``df`` passes through (``keep`` narrows that); a new
    field replaces an input column of the same name, whatever its case.
    """
    new_names = {f.name.lower() for f in new_fields}
    kept = [f for f in df.schema.fields if (keep is None or f.name in keep) and f.name.lower() not in new_names]
    kept_names, field_names = [f.name for f in kept], [f.name for f in new_fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in slices(batch, by):
                new = step(part)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in kept_names), *(new[n] for n in field_names)],
                    names=[*kept_names, *field_names],
                )

    return map_batches(df, run, T.StructType([*kept, *new_fields]))


def attach(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per key and the number of rows
    of that key in ``weight``. Keys of more than ``total / P`` rows (fewer than P, whatever the
    data) are broadcast, the others joined by a shuffle."""
    total, most = table.agg(F.coalesce(F.sum(weight), F.lit(0)), F.coalesce(F.max(weight), F.lit(0))).first()
    limit = total // target_parallelism(rows.sparkSession) + 1
    if most <= limit:
        return rows.join(table.drop(weight), keys, how)
    hot = table.where(F.col(weight) > limit).drop(weight)
    cold = table.where(F.col(weight) <= limit).drop(weight)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(cold, keys, how))


ship_by_value(__name__)
