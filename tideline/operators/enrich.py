"""Enrichment through an external call."""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Calls:
    """Makes calls side by side, each with a time limit of its own.

    A call has a thread to itself. One that runs over its limit gives up its place
    at once and is left behind; what it still returns is ignored.
    """

    def __init__(self, call: Callable[[str], str], places: int, timeout: float):
        self.call, self.places, self.timeout = call, places, timeout
        self.finished: queue.SimpleQueue = queue.SimpleQueue()

    def _run(self, number: int, value: str) -> None:
        try:
            self.finished.put((number, self.call(value), None))
        except BaseException as error:  # raised again in the task
            self.finished.put((number, None, error))

    def results(self, values: list[str]) -> list[str]:
        out: list[str | None] = [None] * len(values)
        began: dict[int, float] = {}
        base = getattr(self, "_next", 0)
        self._next = base + len(values)
        started = 0
        while started < len(values) or began:
            while started < len(values) and len(began) < self.places:
                began[started] = time.monotonic()
                args = (base + started, values[started])
                threading.Thread(target=self._run, args=args, daemon=True).start()
                started += 1
            first = min(began.values()) + self.timeout  # the place that runs out next
            try:
                number, result, error = self.finished.get(timeout=max(0.0, first - time.monotonic()))
            except queue.Empty:
                now = time.monotonic()
                for k in [k for k, t in began.items() if now - t >= self.timeout]:
                    del began[k]
                    out[k] = f"timeout:{values[k]}"
                continue
            if began.pop(number - base, None) is None:
                continue  # it came too late
            if error is not None:
                raise error
            out[number - base] = result
        return out


def async_enrich(
    df: DataFrame,
    column: str,
    call: Callable[[str], str],
    output: str = "result",
    timeout: float = 30.0,
    threads: int = 10,
) -> DataFrame:
    """Adds ``call(value)`` per row, with ``threads`` calls at a time in each task.

    Each distinct value is looked up once and joined back, so repeated values cost
    one call. A call that takes longer than ``timeout`` seconds from its own start
    gives ``timeout:<value>``, one that raises fails the task. A stream calls this
    on every micro-batch (``foreachBatch``).
    """

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        calls = Calls(call, threads, timeout)
        for batch in batches:
            values = batch[column].tolist()
            yield pd.DataFrame({column: values, output: calls.results(values)})

    kind = df.schema[column].dataType.simpleString()
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    found = values.mapInPandas(look_up, f"`{column}` {kind}, `{output}` string")
    return df.join(found, column, "left")
