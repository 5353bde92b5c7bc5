"""Suffix arrays and common prefixes in numpy."""

from __future__ import annotations

import numpy as np

LANES = 4096


def words_at(text: np.ndarray, big: bool = False) -> np.ndarray:
    """The eight bytes from every position on as an unsigned integer; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    view = np.ndarray((len(text),), ">u8" if big else "<u8", padded, strides=(1,))
    return view.astype(np.uint64)


def place_type(n: int) -> type:
    """The narrowest type for places in a text of ``n`` bytes, since arrays of them make up most of the memory."""
    return np.int32 if n < 2**31 - 1 else np.int64


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffixes of a byte text in order, by Larsson and Sadakane.

    Suffixes begin sorted by eight bytes. Every round doubles the sorted length: within each group of still equal
    suffixes those go first whose continuation has the lesser rank. Groups of one are not touched again.
    """
    n = len(text)
    place = place_type(n)
    key = words_at(text, big=True)
    order = np.argsort(key, kind="stable").astype(place)
    key = key[order]
    head = np.r_[True, key[1:] != key[:-1]] if n else np.zeros(0, bool)
    del key
    rank = np.zeros(n + 1, place)
    rank[n] = -1
    done = 8
    while True:
        # A group's rank is the place of its first.
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(n, dtype=place), place(0)))
        at = np.flatnonzero(~(head & np.r_[head[1:], True])).astype(place) if n else order
        if not len(at):
            return order
        some = order[at]
        pair = rank[some].astype(np.int64)
        pair *= n + 1
        pair += rank[np.minimum(some.astype(np.int64) + done, n)]
        pair += 1
        sub = np.argsort(pair, kind="stable").astype(place)
        order[at] = some[sub]
        pair = pair[sub]
        head[at[1:]] = pair[1:] != pair[:-1]
        head[at[0]] = True
        done *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place in the array, the length of the prefix that its suffix shares with the one before, up to ``most``.

    Kasai's rule, that the next position's prefix is shorter by one at most, is followed along many stretches of the
    text in lock step.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, n, place_type(n))
    before[order[1:]] = order[:-1]
    word = np.concatenate([words_at(text), np.zeros(1, np.uint64)])
    prefix = np.zeros(n, place_type(most))
    lanes = min(n, LANES)
    width = -(-n // lanes)
    begin = np.arange(lanes) * width
    begin = begin[begin < n]
    length = np.zeros(len(begin), np.int64)
    for step in range(width):
        p = begin + step
        if p[-1] >= n:
            p = p[p < n]
            begin, length = begin[: len(p)], length[: len(p)]
        q = before[p]
        length = np.maximum(length - 1, 0)
        limit = np.minimum(n - np.maximum(p, q), most)
        length = np.minimum(length, limit)
        go = np.flatnonzero(length < limit)
        while len(go):
            differ = word[p[go] + length[go]] ^ word[q[go] + length[go]]
            same = np.where(differ == 0, 8, np.bitwise_count((differ & -differ) - np.uint64(1)) >> 3)
            length[go] = np.minimum(length[go] + same, limit[go])
            go = go[(same == 8) & (length[go] < limit[go])]
        prefix[p] = length
    return prefix[order]
