"""Python code that runs inside tasks (pandas functions, stateful processors,
writers) is pickled by value, so executors need no install of this package."""

from __future__ import annotations

import sys


def ship_by_value(module_name: str) -> None:
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module_name])
