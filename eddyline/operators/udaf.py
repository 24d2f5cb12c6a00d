"""User-defined aggregate functions with ``create / add / merge / result``.

Run in two phases like Spark's own hash aggregate: every task folds its rows
into one accumulator per key (``mapInArrow``; flushed early when a task holds
``KEYS_HELD`` keys, so its memory does not grow with the input), the partial accumulators are
shuffled by key and merged (a sorted pass per partition). A key's merge group has at most one
row per input task and flush, so a hot key costs no more than a cold one.

Rows reach the functions as Python values: a null is None, a struct a dict. Null and NaN keys
are groups of their own, as in ``groupBy``. Null values are not added (a group of nulls only
still has a result), unless the function sets ``skip_nulls = False``.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from eddyline.session import target_parallelism


class AggregateFunction:
    """Subclass and implement the four methods (accumulators must pickle)."""

    skip_nulls = True

    def create_accumulator(self) -> Any:
        raise NotImplementedError

    def add(self, value: Any, acc: Any) -> Any:
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        raise NotImplementedError

    def get_result(self, acc: Any) -> Any:
        raise NotImplementedError


class CountFunction(AggregateFunction):
    """Counts elements, null or not."""

    skip_nulls = False

    def create_accumulator(self):
        return 0

    def add(self, value, acc):
        return acc + 1

    def merge(self, a, b):
        return a + b

    def get_result(self, acc):
        return acc


class AverageFunction(AggregateFunction):
    """Accumulator (sum, count)."""

    def create_accumulator(self):
        return (0.0, 0)

    def add(self, value, acc):
        return (acc[0] + value, acc[1] + 1)

    def merge(self, a, b):
        return (a[0] + b[0], a[1] + b[1])

    def get_result(self, acc):
        return acc[0] / acc[1] if acc[1] else None


class ReduceFunction(AggregateFunction):
    """A reducer ``f(a, b)`` as an aggregate function. Partial results of tasks meet in no fixed
    order, so ``f`` must be associative and commutative (an ordered reduce is
    ``udf_reduce.rolling_reduce_fn``)."""

    def __init__(self, reducer):
        self.reducer = reducer

    def create_accumulator(self):
        return None

    def add(self, value, acc):
        return value if acc is None else self.reducer(acc, value)

    def merge(self, a, b):
        return b if a is None else a if b is None else self.reducer(a, b)

    def get_result(self, acc):
        return acc


class _NaN:
    """Stands for NaN in keys: NaN differs from itself, but it is one group."""

    def __reduce__(self):
        return "NAN"


NAN = _NaN()


def key_of(values: tuple) -> tuple:
    return tuple(NAN if isinstance(v, float) and v != v else v for v in values)


def value_of(key: tuple) -> tuple:
    return tuple(float("nan") if v is NAN else v for v in key)


# keys whose accumulators a task holds at a time
KEYS_HELD = 16_384


def _as_batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def partials(
    df: DataFrame, keys: list[str], value: str, fn: AggregateFunction, max_keys_per_flush: int = KEYS_HELD,
    places: Callable[[tuple], list[int]] | None = None,
) -> DataFrame:
    """``(keys..., _acc)``: the pickled accumulators of each task and flush, several for a key. With
    ``places``, a key's accumulator comes once for each of its places, in a column ``_place``."""
    names = [*keys, *(["_place"] if places else []), "_acc"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accs: dict = {}
        types: list = []

        def flush():
            if places:
                rows = [(*value_of(k), at, raw) for k, a in accs.items() for raw in (pickle.dumps(a),) for at in places(k)]
            else:
                rows = [(*value_of(k), pickle.dumps(a)) for k, a in accs.items()]
            accs.clear()
            return _as_batch(rows, [*types, *([pa.int64()] if places else []), pa.binary()], names)

        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            columns = [batch.column(k).to_pylist() for k in keys]
            each = map(key_of, zip(*columns)) if keys else iter([()] * batch.num_rows)
            for k, v in zip(each, batch.column(value).to_pylist()):
                acc = accs[k] if k in accs else fn.create_accumulator()
                accs[k] = acc if v is None and fn.skip_nulls else fn.add(v, acc)
            if len(accs) >= max_keys_per_flush:
                yield flush()
                pa.default_memory_pool().release_unused()
        if accs:
            yield flush()

    place = [T.StructField("_place", T.LongType())] if places else []
    partial_schema = T.StructType([*(df.schema[k] for k in keys), *place, T.StructField("_acc", T.BinaryType())])
    return df.select(*keys, value).mapInArrow(partial, partial_schema)


def aggregate(
    df: DataFrame,
    keys: list[str],
    value: str,
    fn: AggregateFunction,
    result_type: str = "double",
    result_name: str = "result",
    max_keys_per_flush: int = KEYS_HELD,
) -> DataFrame:
    key_fields = [df.schema[k] for k in keys]
    parts = partials(df, keys, value, fn, max_keys_per_flush)
    result = T.StructType.fromDDL(f"`{result_name}` {result_type}").fields[0]
    arrow_result = to_arrow_type(result.dataType)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # partials arrive sorted by key: merge each run of equal keys in one pass
        cur, acc, types = None, None, []
        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            columns = [batch.column(k).to_pylist() for k in keys]
            each = map(key_of, zip(*columns)) if keys else iter([()] * batch.num_rows)
            out = []
            for k, raw in zip(each, batch.column("_acc").to_pylist()):
                a = pickle.loads(raw)
                if k != cur:
                    if cur is not None:
                        out.append((*value_of(cur), fn.get_result(acc)))
                    cur, acc = k, a
                else:
                    acc = fn.merge(acc, a)
            yield _as_batch(out, [*types, arrow_result], [*keys, result_name])
        if cur is not None:
            yield _as_batch([(*value_of(cur), fn.get_result(acc))], [*types, arrow_result], [*keys, result_name])

    if keys:
        ordered = parts.repartition(target_parallelism(df.sparkSession), *keys).sortWithinPartitions(*keys)
    else:
        ordered = parts.repartition(1)  # one row per task
    return ordered.mapInArrow(merge, T.StructType([*key_fields, result]))


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
