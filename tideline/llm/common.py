"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from tideline.session import shared_dir

#: Characters of text that a task works on at once.
PART_CHARS = 1 << 20
#: Characters of words whose results a worker keeps.
MEMO_CHARS = 1 << 23
WHITE = " \t\n\r\x0b\x0c"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, so that its lineage ends there and it is computed once."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def parts(text: str, limit: int = PART_CHARS) -> Iterator[str]:
    """The text in pieces of at least ``limit`` characters that end before ASCII white space.

    Only a stretch without white space can make a piece longer. Joined, the pieces are the text.
    """
    begin = 0
    while len(text) - begin > limit:
        ends = [e for c in WHITE if (e := text.find(c, begin + limit)) >= 0]
        if not ends:
            break
        end = min(ends)
        yield text[begin:end]
        begin = end
    yield text[begin:]


def runs_by_size(items: list, size: Callable, limit: int) -> Iterator[list]:
    """Consecutive items in lists of about ``limit`` in total size."""
    run, total = [], 0
    for item in items:
        if run and total + size(item) > limit:
            yield run
            run, total = [], 0
        run.append(item)
        total += size(item)
    if run:
        yield run


def word_lists(words: list[str]) -> Iterator[list[str]]:
    """Words in lists that are worked on at once: about 20,000 of usual length, fewer of longer ones."""
    return runs_by_size(words, lambda w: 32 + len(w), PART_CHARS)


class Memo(dict):
    """Results by word. What is missing is computed for a whole list of words at once.

    It is emptied when it would hold more than ``most`` words or ``chars`` characters of words, which bounds a worker's
    memory also where a word is a whole line; frequent words are soon back.
    """

    def __init__(self, compute: Callable[[list[str]], list], most: int = 400_000, chars: int = MEMO_CHARS):
        super().__init__()
        self.compute, self.most, self.chars, self.held = compute, most, chars, 0

    def need(self, words: set[str]) -> None:
        """Afterwards every one of ``words`` has its result."""
        missing = [w for w in words if w not in self]
        if not missing:
            return
        size = sum(map(len, missing))
        if len(self) + len(missing) > self.most or self.held + size > self.chars:
            self.clear()
            missing = list(words)
            self.held, size = 0, sum(map(len, missing))
        self.held += size
        for some in word_lists(missing):
            self.update(zip(some, self.compute(some)))


class Rows(dict):
    """Numbers words from 0 as they are first looked up; new ones are listed in ``new`` until they are dealt with."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.new.append(word)
        return row
