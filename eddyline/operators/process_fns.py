"""Process functions of the library itself."""

from __future__ import annotations

from collections.abc import Iterator

from eddyline.operators.process import Context, ProcessFunction


class SplitFunction(ProcessFunction):
    """A line's parts with their places; empty parts at the end are left out (an empty line is one
    empty part), as ``functions.text.java_split`` does."""

    def __init__(self, keep: tuple[str, ...], separator: str, value: str = "value"):
        self.keep, self.separator, self.value = keep, separator, value

    def process_element(self, element: dict, ctx: Context) -> Iterator[tuple]:
        line = element[self.value]
        if line is None:
            return
        parts = line.split(self.separator)
        if len(parts) > 1:
            while parts and not parts[-1]:
                parts.pop()
        head = tuple(element[c] for c in self.keep)
        for place, part in enumerate(parts):
            yield *head, place, part


class AlertFunction(ProcessFunction):
    """Readings pass through; those above ``limit`` also go to the side output ``alerts`` with the
    excess and the time."""

    def __init__(self, limit: float):
        self.limit = limit

    def process_element(self, element: dict, ctx: Context) -> Iterator[tuple]:
        value = element["vc"]
        if value is not None and value > self.limit:
            ctx.output("alerts", element["seq"], element["id"], value - self.limit, ctx.timestamp)
        yield element["seq"], element["id"], value


from eddyline._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)
