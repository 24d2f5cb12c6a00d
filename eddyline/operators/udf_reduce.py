"""Rolling ``reduce`` with an arbitrary Python reducer (batch form).

The reducer must be associative (``f(f(a, b), c) == f(a, f(b, c))``), which is what
lets a key's history be cut into parts: each (key, bucket) group is folded
locally in order (one sorted pass per partition), the bucket totals of hot keys (at most 2P
rows) are folded into per-bucket offsets, and every row's value is
``f(offset, local)``. Buckets come from ``prefix.assign_buckets``, so a hot key
never lands in one task. Prefer ``keyed`` operators when a built-in aggregate
expresses the reducer: they stay in the JVM.

Records reach the reducer as dicts of Python values (a null is None). Null and NaN keys
accumulate as keys of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.operators.prefix import assign_buckets
from eddyline.operators.udaf import key_of
from eddyline.session import target_parallelism

Record = dict
Reducer = Callable[[Record, Record], Record]


def latest_max_reducer(field: str, latest: tuple[str, ...]) -> Reducer:
    """The reference's reducer as a Python function: newest ``latest`` fields, max ``field``."""

    def f(a: Record, b: Record) -> Record:
        out = dict(a)
        for c in latest:
            out[c] = b[c]
        out[field] = greater(a[field], b[field])
        return out

    return f


def greater(a, b):
    """The larger value as SQL's max sees it: nulls do not count, NaN is above all numbers."""
    if a is None or b is None:
        return b if a is None else a
    return a if a != a or (b == b and a >= b) else b


def _batch(columns: list, fields: list[pa.Field]) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])


def rolling_reduce_fn(
    df: DataFrame, key: str, order: str, fields: list[str], reducer: Reducer, hot_rows: float | None = None
) -> DataFrame:
    """``keyBy(key).reduce(reducer)``: one output per input row, the key's fold so far.
    Output columns: ``order``, ``key``, ``fields``."""
    base = df.select(key, order, *fields)
    b = assign_buckets(base, [key], [order], hot_rows)
    staged = b.df
    field_types = T.StructType([base.schema[c] for c in fields])
    local_schema = T.StructType(
        [base.schema[key], T.StructField("_b", T.LongType()), T.StructField("_hot", T.BooleanType()), base.schema[order]]
        + list(field_types.fields)
    )
    cols = [key, "_b", "_hot", order, *fields]

    def local_fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows arrive sorted by (key, bucket, order): fold each run of equal
        # (key, bucket) in one pass; a run may continue in the next batch
        cur, acc = None, None
        for batch in batches:
            given = [batch.column(c).to_pylist() for c in cols]
            out = []
            for row in zip(*given):
                g = key_of(row[:2])
                rec = dict(zip(fields, row[4:]))
                if g != cur:
                    cur, acc = g, rec
                else:
                    acc = reducer(acc, rec)
                out.append([acc[c] for c in fields])
            folded = list(zip(*out)) if out else [()] * len(fields)
            yield _batch([*given[:4], *folded], [batch.schema.field(c) for c in cols])

    ordered = staged.select(*cols).repartition(target_parallelism(df.sparkSession), key, "_b")
    local = ordered.sortWithinPartitions(key, "_b", order).mapInArrow(local_fold, local_schema)
    if not b.any_hot:
        return local.select(order, key, *fields)

    # last (newest) value of every hot bucket: a JVM aggregate, at most 2P rows
    last = F.max(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in fields])).alias("_m")
    totals = local.filter("_hot").groupBy(key, "_b").agg(last).select(key, "_b", *[F.col(f"_m.{c}").alias(c) for c in fields])
    prev_cols = [f"_p_{c}" for c in fields]
    off_schema = T.StructType(
        [T.StructField("_okey", base.schema[key].dataType), T.StructField("_ob", T.LongType())]
        + [T.StructField(p, f.dataType) for p, f in zip(prev_cols, field_types.fields)]
        + [T.StructField("_has", T.BooleanType())]
    )

    def prefix_fold(_: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["_b"])
        acc, out = None, []
        for rec in rows:
            if acc is not None:
                out.append((rec[key], rec["_b"], *(acc[c] for c in fields), True))
            part = {c: rec[c] for c in fields}
            acc = part if acc is None else reducer(acc, part)
        types = [table.schema.field(c).type for c in (key, "_b", *fields)] + [pa.bool_()]
        columns = zip(*out) if out else [()] * len(types)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=[f.name for f in off_schema.fields])

    # at most 2P rows (hot keys' buckets), so the broadcast is bounded
    offsets = F.broadcast(totals.groupBy(key).applyInArrow(prefix_fold, off_schema))
    joined = local.join(offsets, local[key].eqNullSafe(offsets["_okey"]) & (local["_b"] == offsets["_ob"]), "left")
    out_schema = T.StructType([base.schema[order], base.schema[key]] + list(field_types.fields))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recs = list(zip(*(batch.column(c).to_pylist() for c in fields)))
            prevs = list(zip(*(batch.column(c).to_pylist() for c in prev_cols)))
            vals = []
            for has, rec, prev in zip(batch.column("_has").to_pylist(), recs, prevs):
                rec = dict(zip(fields, rec))
                rec = reducer(dict(zip(fields, prev)), rec) if has else rec
                vals.append([rec[c] for c in fields])
            folded = list(zip(*vals)) if vals else [()] * len(fields)
            head = [batch.column(order).to_pylist(), batch.column(key).to_pylist()]
            yield _batch([*head, *folded], [batch.schema.field(c) for c in (order, key, *fields)])

    return joined.select(local[order], local[key], *[local[c] for c in fields], *prev_cols, "_has").mapInArrow(combine, out_schema)


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
