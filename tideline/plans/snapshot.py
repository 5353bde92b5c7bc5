"""From a snapshot to the log without a gap: chunks are read while changes go on.

Every chunk of a table is read between two places of the log, its low and its high
mark. Its rows are merged as of the low mark. Changes that the log has up to there lose
to them, since the chunk has seen them; later ones win, be they read before the chunk is
merged or after it. So chunks and log are read side by side, in any order, and a chunk
that is read again changes nothing. The table is the source's state at a place of the log
as soon as the log has been applied up to there and beyond every high mark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.plans.sync import DatabaseSync


@dataclass(frozen=True)
class Chunk:
    """The rows of one key range, and the log's end before and after they were read."""

    rows: DataFrame
    low: int
    high: int


def read_chunks(predicates: list[str], read: Callable[[str], DataFrame], log_end: Callable[[], int]) -> Iterator[Chunk]:
    """Reads a table range by range; ``log_end`` says where the source's log ends at the moment.

    A chunk must be read between its marks, so ``read`` returns rows that have been read already: a written table,
    not a plan that reads the source later.
    """
    for predicate in predicates:
        low = log_end()
        rows = read(predicate)
        yield Chunk(rows, low, log_end())


class Handover:
    """Merges the chunks of one table while :class:`DatabaseSync` applies the log.

    ``start`` is where the log is read from. While a hand-over is open, the sync keeps its tombstones from there on:
    a row that was deleted after its chunk was read must not come back with the chunk.
    """

    def __init__(self, sync: DatabaseSync, db: str, name: str, columns: list[tuple[str, str]], key: list[str], start: int):
        if not key:
            raise ValueError("a table without a key has nothing to tell a changed row by")
        self.sync, self.db, self.name, self.columns, self.key = sync, db, name, columns, key
        self.high = start
        sync.create(db, name, columns, key)
        sync.hold(db, name, start)

    def merge(self, chunk: Chunk) -> None:
        """Puts a chunk under the changes after its low mark."""
        rows = chunk.rows.select(*[c for c, _ in self.columns])
        rows = rows.withColumns({"seq": F.lit(chunk.low).cast("long"), "kind": F.lit("insert")})
        self.sync.table(self.db, self.name).merge(rows)
        self.high = max(self.high, chunk.high)

    def finish(self) -> int:
        """Closes the hand-over; returns the place in the log from which on the table is consistent."""
        self.sync.hold(self.db, self.name, None)
        return self.high
