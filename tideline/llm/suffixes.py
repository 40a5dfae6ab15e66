"""Suffix order of a byte string, and the longest factors that occur earlier or later in it."""

from __future__ import annotations

import numpy as np


def prefix_ranks(text: np.ndarray, cap: int) -> dict[int, np.ndarray]:
    """For lengths 8, 24, 72 .. below `cap`, and `cap` (8 or more): the rank of each place by its next bytes.

    Past the end of the text come zeros, so what is left of a suffix ranks before all that go on with
    other bytes than zero. Each length joins three ranks of the one before in one number.
    """
    padded = np.append(text, np.zeros(8, np.uint8)).astype(np.uint64)
    packed = np.zeros(len(text) + 1, np.uint64)
    for k in range(8):
        packed = packed << np.uint64(8) | padded[k: k + len(packed)]
    ranks = {8: np.unique(packed, return_inverse=True)[1]}
    length, last = 8, len(text)
    while length < cap:
        longer = min(3 * length, cap)
        have = ranks[length]
        size = int(have.max()) + 1
        second = have[np.minimum(np.arange(last + 1) + min(length, longer - length), last)]
        joined = have * size + second
        if longer > 2 * length and size < 1 << 21:
            joined = joined * size + have[np.minimum(np.arange(last + 1) + longer - length, last)]
        else:
            longer = min(2 * length, longer)
        ranks[longer] = np.unique(joined, return_inverse=True)[1]
        length = longer
    return ranks


def common_length(text: np.ndarray, ranks: dict[int, np.ndarray], left: np.ndarray, right: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at `left` and `right`, at most `cap`."""
    last = len(text)
    total = np.where(ranks[cap][left] == ranks[cap][right], cap, 0)
    open_ = np.flatnonzero(total == 0)
    for length in [*sorted((x for x in ranks if x < cap), reverse=True), 1]:
        for _ in range(7 if length == 1 else 2):
            x, y = left[open_] + total[open_], right[open_] + total[open_]
            inside = (x < last) & (y < last)
            x, y = np.minimum(x, last - 1), np.minimum(y, last - 1)
            values = text if length == 1 else ranks[length]
            total[open_] += np.where(inside & (values[x] == values[y]), length, 0)
    return np.minimum(np.minimum(total, cap), last - np.maximum(left, right))


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller value, or -1; by pointer jumping."""
    link = np.arange(len(values)) - 1
    while True:
        wrong = np.flatnonzero((link >= 0) & (values[link] > values))
        if not len(wrong):
            return link
        link[wrong] = link[link[wrong]]


def neighbours(order: np.ndarray, sign: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and, before and after them in suffix order, the nearest that start earlier (sign 1) or later (-1)."""
    found = []
    for along in (order, order[::-1]):
        near = nearest_smaller(along * sign)
        has = np.flatnonzero(near >= 0)
        found.append((along[has], along[near[has]]))
    return found


def longest_factors(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the length (up to `cap`) of its longest match that starts earlier, and later.

    In suffix order the best earlier match of a place is the nearest suffix before or after it that
    starts at a smaller place; the best later match is its mirror image.
    """
    found = [np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)]
    if len(text):
        ranks = prefix_ranks(text, cap)
        order = np.argsort(ranks[cap][: len(text)], kind="stable")
        for best, sign in zip(found, (1, -1), strict=True):
            for place, other in neighbours(order, sign):
                best[place] = np.maximum(best[place], common_length(text, ranks, place, other, cap))
    return found[0], found[1]


def long_matches(text: np.ndarray, length: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted place has a match of that length with a wanted place that starts earlier, and later."""
    found = [np.zeros(len(text), bool), np.zeros(len(text), bool)]
    places = np.flatnonzero(wanted)
    if len(places):
        rank = prefix_ranks(text, length)[length]
        order = places[np.argsort(rank[places], kind="stable")]
        for hit, sign in zip(found, (1, -1), strict=True):
            for place, other in neighbours(order, sign):
                hit[place[rank[place] == rank[other]]] = True
    return found[0], found[1]
