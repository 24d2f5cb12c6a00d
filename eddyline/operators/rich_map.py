"""Map with a per-task lifecycle (``RichMapFunction``: open / map / close).

``mapInPandas`` hands each task an iterator of Arrow batches: code before the
loop is ``open``, the ``finally`` block is ``close``; both run once per task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


class RichMapFunction:
    """Override ``open``, ``map`` (a pandas batch -> pandas batch) and ``close``."""

    def open(self) -> None:  # noqa: D401 - lifecycle hook
        pass

    def map(self, batch: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


def rich_map(df: DataFrame, factory: Callable[[], RichMapFunction], schema: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = factory()
        fn.open()
        try:
            for b in batches:
                yield fn.map(b)
        finally:
            fn.close()

    return df.mapInPandas(run, schema)


# What the record parsers accept: a sign and digits; a decimal number, also with a type letter
# behind it, or exactly NaN / Infinity (never the spellings inf or nan).
LONG_TEXT = re.compile(r"[+-]?[0-9]+")
DOUBLE_TEXT = re.compile(r"([+-]?(?:NaN|Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?))(?:(?<=[0-9.])[dDfF])?")
JAVA_BLANKS = "".join(map(chr, range(33)))


class SensorLineParser(RichMapFunction):
    """Parses ``id,ts,vc`` lines (column ``value``) like the reference's map; a
    bad line fails the task. Other input columns pass through in front."""

    def __init__(self, keep: tuple[str, ...] = ()):
        self.keep = keep
        self.rows = 0

    def open(self) -> None:
        self.rows = 0

    @staticmethod
    def parse(line: str | None) -> tuple[str, int, float]:
        """One line by the rules of ``functions.text.parse_sensor``."""
        parts = ("" if line is None else line).split(",")
        if len(parts) < 3:
            raise ValueError(f"short sensor line: {line!r}")
        if not LONG_TEXT.fullmatch(parts[1]) or not -(1 << 63) <= int(parts[1]) < 1 << 63:
            raise ValueError(f"bad ts in sensor line: {line!r}")
        number = DOUBLE_TEXT.fullmatch(parts[2].strip(JAVA_BLANKS))
        if not number:
            raise ValueError(f"bad vc in sensor line: {line!r}")
        return parts[0], int(parts[1]), float(number[1])

    def map(self, batch: pd.DataFrame) -> pd.DataFrame:
        rows = [self.parse(line) for line in batch["value"]]
        out = batch[list(self.keep)].copy()
        out["id"] = pd.Series([r[0] for r in rows], index=out.index, dtype="object")
        out["ts"] = pd.Series([r[1] for r in rows], index=out.index, dtype="int64")
        out["vc"] = pd.Series([r[2] for r in rows], index=out.index, dtype="float64")
        self.rows += len(out)
        return out


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
