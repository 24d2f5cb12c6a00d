"""Keyed aggregates, rolling (one output per input) or final (one row per key).

The reference's rolling ``sum``/``max``/``maxBy``/``reduce`` depend on arrival
order; a table has none, so every rolling operator takes ``order``: a column
that is unique within a key. Rolling values run through ``prefix.running``,
which keeps hot keys parallel. Final values are plain grouped aggregates
(partial aggregation before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.prefix import Running, running


def _check_emit(emit: str) -> None:
    if emit not in ("rolling", "final"):
        raise ValueError("emit must be 'rolling' or 'final'")


def _stream_rolling(df: DataFrame, key: str, order: str, fields: list[str], reducer) -> DataFrame:
    """Rolling values on a stream: ``transformWithState`` keeps the key's record
    in the state store and emits one row per input (output mode ``update``)."""
    from pyspark.sql import types as T

    from eddyline.streaming.stateful import RollingProcessor, use_rocksdb

    use_rocksdb(df.sparkSession)
    rec = [key, *[f for f in fields if f != key]]
    state = T.StructType([df.schema[c] for c in rec])
    out = T.StructType([df.schema[order], *state.fields])
    proc = RollingProcessor(rec, state, reducer, order=order)
    return df.groupBy(key).transformWithState(proc, out, "Update", "None")


def keyed_sum(
    df: DataFrame,
    key: str,
    field: str,
    order: str | None = None,
    emit: str = "final",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``keyBy(key).sum(field)``.

    Rolling: each input row gets the running sum; the ``carry`` fields keep the
    values of the key's first record (the library copies the first record and
    only advances the summed field). Final: one row per key.
    """
    _check_emit(emit)
    if order is None and (carry or emit == "rolling"):
        raise ValueError("carried fields and rolling sums need an order column")
    if emit == "final":
        aggs = [F.sum(field).alias(field)]
        aggs += [F.min(F.struct(F.col(order), F.col(c).alias("v"))).getField("v").alias(c) for c in carry]
        return df.groupBy(key).agg(*aggs)
    if df.isStreaming:
        from eddyline.streaming.stateful import sum_reducer

        return _stream_rolling(df, key, order, [*carry, field], sum_reducer(field)).select(order, key, *carry, field)
    specs = [Running(field, "sum", F.col(field))] + [Running(c, "first", F.col(c)) for c in carry]
    out = running(df.select(order, key, field, *carry), [key], [order], specs)
    return out.select(order, key, *carry, field)


def keyed_max(
    df: DataFrame, key: str, field: str, order: str, emit: str = "rolling", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``keyBy(key).max(field)``: only ``field`` advances; ``carry`` fields stay
    those of the key's first record."""
    _check_emit(emit)
    if emit == "final":
        first = [F.min(F.struct(F.col(order), F.col(c).alias("v"))).getField("v").alias(c) for c in carry]
        return df.groupBy(key).agg(*first, F.max(field).alias(field))
    if df.isStreaming:
        from eddyline.streaming.stateful import max_reducer

        return _stream_rolling(df, key, order, [*carry, field], max_reducer(field)).select(order, key, *carry, field)
    specs = [Running(c, "first", F.col(c)) for c in carry] + [Running(field, "max", F.col(field))]
    out = running(df.select(order, key, field, *carry), [key], [order], specs)
    return out.select(order, key, *carry, field)


def keyed_max_by(
    df: DataFrame,
    key: str,
    field: str,
    order: str,
    record: tuple[str, ...],
    first: bool = False,
    emit: str = "rolling",
) -> DataFrame:
    """``keyBy(key).maxBy(field, first)``: the whole record holding the maximum.
    Ties: ``first=False`` returns the latest record, ``first=True`` the earliest.

    A struct ``(field, tie, record...)`` is maximised, which is deterministic
    (``max_by`` leaves ties undefined). ``order`` must be numeric for ``first=True``.
    """
    _check_emit(emit)
    tie = -F.col(order) if first else F.col(order)
    packed = F.struct(F.col(field).alias("_f"), tie.alias("_t"), *[F.col(c) for c in record])
    if emit == "final":
        best = df.groupBy(key).agg(F.max(packed).alias("_m"))
        return best.select(key, *[F.col("_m").getField(c).alias(c) for c in record])
    if df.isStreaming:
        from eddyline.streaming.stateful import max_by_reducer

        fields = list(dict.fromkeys([*record, field]))
        out = _stream_rolling(df, key, order, fields, max_by_reducer(field, first))
        return out.select(order, key, *record)
    out = running(df.select(order, key, packed.alias("_pk")), [key], [order], [Running("_m", "max", F.col("_pk"))])
    return out.select(order, key, *[F.col("_m").getField(c).alias(c) for c in record])


def keyed_reduce_latest_max(
    df: DataFrame, key: str, field: str, order: str, latest: tuple[str, ...] = (), emit: str = "rolling"
) -> DataFrame:
    """The reference's reducer ``(v1, v2) -> (v1.key, v2.latest..., max(v1.field, v2.field))``:
    the ``latest`` fields come from the newest record, ``field`` is the running
    maximum; the first record passes through unchanged."""
    _check_emit(emit)
    if emit == "final":
        last = [F.max(F.struct(F.col(order), F.col(c).alias("v"))).getField("v").alias(c) for c in latest]
        return df.groupBy(key).agg(*last, F.max(field).alias(field))
    if df.isStreaming:
        from eddyline.streaming.stateful import latest_max_reducer

        out = _stream_rolling(df, key, order, [*latest, field], latest_max_reducer(field, latest))
        return out.select(order, key, *latest, field)
    specs = [Running(c, "last", F.col(c)) for c in latest] + [Running(field, "max", F.col(field))]
    out = running(df.select(order, key, field, *latest), [key], [order], specs)
    return out.select(order, key, *latest, field)


def word_pairs(words: DataFrame, col: str = "word") -> DataFrame:
    """``map(w -> (w, 1))``."""
    return words.select(F.col(col).alias("word"), F.lit(1).cast("long").alias("one"))


def key_expr(expr: Column | str) -> Column:
    """Key by function: any column expression can be the grouping key."""
    return F.expr(expr) if isinstance(expr, str) else expr
