"""User process functions: any number of rows per element, a lifecycle, and side outputs.

``ProcessFunction`` is one class for tables and streams (stateless: per element; keyed state has its
own processors in ``streaming``). It runs inside the tasks over Arrow batches, without a shuffle:
``open`` and ``close`` once per task, ``process_element`` per element, which yields rows of the main
output and gives rows to side outputs by name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


@dataclass
class Context:
    """What a process function sees beside the element."""

    partition: int
    timestamp: Any = None  # the element's event time, if a time column was named
    sides: dict[str, list[tuple]] = field(default_factory=dict)

    def output(self, tag: str, *row) -> None:
        """Give a row to the side output ``tag``."""
        self.sides[tag].append(row)


class ProcessFunction:
    """Override ``process_element`` (yields tuples) and, if need be, ``open`` and ``close``."""

    def open(self, ctx: Context) -> None:
        pass

    def process_element(self, element: dict, ctx: Context) -> Iterator[tuple]:
        raise NotImplementedError

    def close(self) -> None:
        pass


@dataclass
class Processed:
    """The outputs of ``process``. Each reads the tagged rows anew; ``materialize(tagged)`` first where
    several are used on a table."""

    tagged: DataFrame

    def _of(self, tag: str) -> DataFrame:
        return self.tagged.where(F.col("_tag") == tag).select(f"{tag}.*")

    @property
    def main(self) -> DataFrame:
        return self._of("main")

    def side(self, tag: str) -> DataFrame:
        return self._of(tag)


def process(
    df: DataFrame,
    factory: Callable[[], ProcessFunction],
    schema: str,
    sides: dict[str, str] | None = None,
    ts: str | None = None,
) -> Processed:
    """Run a process function over every row of ``df`` (a table or a stream). ``schema`` and ``sides`` (by
    name) are the columns of the outputs; ``ts`` names the time column that the context shows."""
    kinds = {"main": T.StructType.fromDDL(schema)} | {tag: T.StructType.fromDDL(s) for tag, s in (sides or {}).items()}
    if len(kinds) != 1 + len(sides or {}) or "_tag" in kinds:
        raise ValueError("'main' and '_tag' name no side output")
    arrow = {tag: [pa.field(f.name, to_arrow_type(f.dataType)) for f in kind.fields] for tag, kind in kinds.items()}
    out_schema = T.StructType([T.StructField("_tag", T.StringType()), *(T.StructField(t, k) for t, k in kinds.items())])

    def batch_of(rows: dict[str, list[tuple]]) -> pa.RecordBatch:
        tags = [tag for tag in arrow for _ in rows[tag]]
        columns = [pa.array(tags, pa.string())]
        at = 0
        for tag, fields in arrow.items():
            mine = rows[tag]
            after = len(tags) - at - len(mine)
            parts = [
                pa.concat_arrays([pa.nulls(at, f.type), pa.array([r[k] for r in mine], f.type), pa.nulls(after, f.type)])
                for k, f in enumerate(fields)
            ]
            absent = pa.array([True] * at + [False] * len(mine) + [True] * after, pa.bool_())
            columns.append(pa.StructArray.from_arrays(parts, fields=fields, mask=absent))
            at += len(mine)
        return pa.RecordBatch.from_arrays(columns, names=["_tag", *arrow])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        ctx = Context(task.partitionId() if task else 0)
        fn = factory()
        ctx.sides = {tag: [] for tag in arrow if tag != "main"}
        fn.open(ctx)
        try:
            for batch in batches:
                main: list[tuple] = []
                for element in batch.to_pylist():
                    ctx.timestamp = element[ts] if ts else None
                    main.extend(fn.process_element(element, ctx))
                yield batch_of({"main": main, **ctx.sides})
                for rows in ctx.sides.values():
                    rows.clear()
        finally:
            fn.close()

    return Processed(df.mapInArrow(run, out_schema))


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
