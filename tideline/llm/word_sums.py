"""Sums over a text's words of numbers that depend on the word alone."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from tideline.llm.common import MEMO_CHARS, Rows, parts, runs_by_size, word_lists

RUN_CHARS = 1 << 21


class WordSums:
    """Holds each word's numbers in a row of a table; most words of a text have been seen before.

    Words are what stands between white space. The table is emptied once it holds more than ``most`` words
    or ``MEMO_CHARS`` characters of words.
    """

    def __init__(self, compute: Callable[[list[str]], np.ndarray], width: int, most: int = 300_000):
        self.compute, self.most = compute, most
        self.row, self.chars = Rows(), 0
        self.table = np.zeros((1024, width))

    def learn(self) -> None:
        """Computes the rows of the words that have been numbered but not computed yet."""
        new, total = self.row.new, len(self.row)
        if total > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((total, self.table.shape[1]))])
        first = total - len(new)
        for some in word_lists(new):
            self.table[first : first + len(some)] = self.compute(some)
            first += len(some)
        self.chars += sum(map(len, new))
        new.clear()

    def sums(self, texts: list[str]) -> np.ndarray:
        """A row for each whole text: the sum over all its words."""
        out = np.zeros((len(texts), self.table.shape[1]))
        first = 0
        for run in runs_by_size(texts, len, RUN_CHARS):
            if len(run) == 1:
                for part in parts(run[0], RUN_CHARS):
                    out[first] += self.of([part.split()])[0]
            else:
                out[first : first + len(run)] = self.of([text.split() for text in run])
            first += len(run)
        return out

    def of(self, lists: list[list[str]]) -> np.ndarray:
        """A row for each list of words."""
        if len(self.row) > self.most or self.chars > MEMO_CHARS:
            self.row, self.chars = Rows(), 0
        out = np.zeros((len(lists), self.table.shape[1]))
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        rows = np.fromiter(map(self.row.__getitem__, chain.from_iterable(lists)), np.int64, int(size.sum()))
        if self.row.new:
            self.learn()
        some = np.flatnonzero(size)
        if len(some):
            out[some] = np.add.reduceat(self.table[rows], (np.cumsum(size) - size)[some], axis=0)
        return out
