"""Whole-group Python functions without per-group task overhead.

``applyInPandas`` starts a pandas frame per group; with many small groups
(keys x windows) that overhead dominates. Here the rows are hash-partitioned by
the group keys and sorted within each partition, and one ``mapInPandas`` pass
hands each run of equal keys to the function (runs that cross Arrow batch
boundaries are joined once, when they end). One group still has to fit one worker.
Null and NaN keys are groups of their own, as in ``groupBy``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.session import target_parallelism


def map_groups(
    df: DataFrame,
    keys: list[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    order: list[str] | None = None,
) -> DataFrame:
    """Apply ``fn`` to every group of ``keys`` (rows ordered by ``order`` inside it).
    ``fn`` returns a pandas frame, or a dict for a single output row (cheaper)."""
    order = order or []

    def emit(results: list) -> pd.DataFrame | None:
        rows = [r for r in results if isinstance(r, dict)]
        frames = [r for r in results if not isinstance(r, dict)]
        if rows:
            frames.append(pd.DataFrame(rows))
        return pd.concat(frames, ignore_index=True) if frames else None

    # pandas shows a null number as NaN, so Spark says which keys are null
    flags = [f"_null{i}" for i in range(len(keys))]

    def starts_of(pdf: pd.DataFrame) -> list[int]:
        new = np.zeros(len(pdf), bool)
        new[0] = True
        for k, flag in zip(keys, flags):
            v, null = pdf[k].to_numpy(), pdf[flag].to_numpy()
            differs = np.asarray(v[1:] != v[:-1], bool)
            if v.dtype.kind in "fOmM":  # NaN differs from itself, but it is one group
                nan = pd.isna(v)
                differs &= ~(nan[1:] & nan[:-1])
            new[1:] |= differs | (null[1:] != null[:-1])
        return np.flatnonzero(new).tolist()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_run: list[pd.DataFrame] = []  # pieces of the run that may go on

        def call(pieces: list[pd.DataFrame]):
            whole = pieces[0] if len(pieces) == 1 else pd.concat(pieces, ignore_index=True)
            whole.index = pd.RangeIndex(len(whole))
            return fn(whole)

        last = None  # the last row seen, with its flags
        for pdf in batches:
            if pdf.empty:
                continue
            # does the first row of this batch go on with the open run?
            goes_on = last is not None and len(starts_of(pd.concat([last, pdf.iloc[:1]], ignore_index=True))) == 1
            last, rows = pdf.iloc[-1:], pdf.drop(columns=flags)
            bounds = [*starts_of(pdf), len(pdf)]
            results = []
            for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                if open_run and not (k == 0 and goes_on):
                    results.append(call(open_run))
                    open_run = []
                open_run.append(rows.iloc[a:b])
            out = emit(results)
            if out is not None:
                yield out
        if open_run:
            out = emit([call(open_run)])
            if out is not None:
                yield out

    # an explicit partition count: AQE would otherwise coalesce a small shuffle into
    # one task and serialise the Python work
    ordered = df.repartition(target_parallelism(df.sparkSession), *keys).sortWithinPartitions(*keys, *order)
    return ordered.withColumns({n: F.col(k).isNull() for n, k in zip(flags, keys)}).mapInPandas(run, schema)


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
