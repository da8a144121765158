"""Suffix arrays by induced sorting and their permuted common prefixes, for one shard."""

from __future__ import annotations

import numpy as np


def _smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last, a unique least symbol, is."""
    step = np.r_[np.sign(text[1:].astype(np.int64) - text[:-1]), 1]
    at = np.where(step != 0, np.arange(len(step)), len(step) - 1)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _leftmost(smaller: np.ndarray) -> np.ndarray:
    """Places of the smaller suffixes that follow a larger one."""
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


class _Pending:
    """Suffixes that wait in the buckets of their first symbols, in order of arrival."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.text = text
        self.parts: list[list[np.ndarray]] = [[] for _ in range(symbols)]

    def add(self, places: np.ndarray) -> None:
        if len(places):
            symbols = self.text[places]
            order = np.argsort(symbols, kind="stable")
            places, symbols = places[order], symbols[order]
            edges = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1], True])
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                self.parts[symbols[low]].append(places[low:high])

    def take(self, symbol: int) -> np.ndarray:
        return _joined(self.parts[symbol])


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def _induce(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix array that follows from the order of the leftmost smaller suffixes.

    A scan of a bucket puts the larger suffixes before its entries into their buckets, then
    a scan backwards the smaller ones. What a scan puts into its own bucket comes in waves, as
    many as a run of the symbol is long; all others of a bucket are put at once.
    """
    seeds = _Pending(text, symbols)
    seeds.add(leftmost)
    larger, small = _Pending(text, symbols), _Pending(text, symbols)
    of_larger: list[np.ndarray] = []
    for symbol in range(symbols):
        wave, entries, before = larger.take(symbol), [], []
        while len(wave):
            entries.append(wave)
            previous = wave[wave > 0] - 1
            previous = previous[~smaller[previous]]
            same = text[previous] == symbol
            before.append(previous[~same])
            wave = previous[same]
        of_larger.append(_joined(entries))
        starts = seeds.take(symbol)
        before.append(starts[starts > 0] - 1)
        larger.add(_joined(before))
    small.add(np.array([len(text) - 1]))
    of_smaller: list[np.ndarray] = []
    for symbol in range(symbols - 1, -1, -1):
        wave, entries, before = small.take(symbol), [], []
        while len(wave):
            entries.append(wave)
            previous = wave[wave > 0] - 1
            previous = previous[smaller[previous]]
            same = text[previous] == symbol
            before.append(previous[~same])
            wave = previous[same]
        of_smaller.append(_joined(entries)[::-1])
        ends = of_larger[symbol][::-1]
        previous = ends[ends > 0] - 1
        before.append(previous[smaller[previous]])
        small.add(_joined(before))
    parts = []
    for symbol in range(symbols):
        parts += [of_larger[symbol], of_smaller[symbols - 1 - symbol]]
    return np.concatenate(parts)


def _named(text: np.ndarray, order: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers of the substrings between neighbouring ``places``, equal ones the same, in the
    sequence of ``order``."""
    end = np.empty(len(text), dtype=np.int64)
    end[places] = np.r_[places[1:], places[-1]]
    length = end[order] - order
    same = np.r_[False, length[1:] == length[:-1]]
    left, at = np.flatnonzero(same), 0
    while len(left):
        equal = text[order[left] + at] == text[order[left - 1] + at]
        same[left[~equal]] = False
        left = left[equal & (length[left] > at)]
        at += 1
    return np.cumsum(~same) - 1


def _sort_names(names: list[int]) -> list[int]:
    """Suffix array of a list of numbers that ends with its only 0: the same scans, one entry
    at a time, for alphabets about as large as the list."""
    n, symbols = len(names), max(names) + 1
    if symbols == n:
        order = [0] * n
        for place, name in enumerate(names):
            order[name] = place
        return order
    smaller = [True] * n
    for i in range(n - 2, -1, -1):
        a, b = names[i], names[i + 1]
        smaller[i] = a < b or (a == b and smaller[i + 1])
    leftmost = [i for i in range(1, n) if smaller[i] and not smaller[i - 1]]
    counts = [0] * symbols
    for name in names:
        counts[name] += 1
    heads, total = [], 0
    for count in counts:
        heads.append(total)
        total += count
    tails = [head + count - 1 for head, count in zip(heads, counts, strict=True)]

    def induce(seeds: list[int]) -> list[int]:
        order = [-1] * n
        at = tails.copy()
        for place in reversed(seeds):
            name = names[place]
            order[at[name]] = place
            at[name] -= 1
        at = heads.copy()
        for i in range(n):
            place = order[i] - 1
            if place >= 0 and not smaller[place]:
                name = names[place]
                order[at[name]] = place
                at[name] += 1
        at = tails.copy()
        for i in range(n - 1, -1, -1):
            place = order[i] - 1
            if place >= 0 and smaller[place]:
                name = names[place]
                order[at[name]] = place
                at[name] -= 1
        # The last suffix follows from none.
        order[0] = n - 1
        return order

    isleft = [False] * n
    for place in leftmost:
        isleft[place] = True
    by_substring = [place for place in induce(leftmost) if isleft[place]]
    numbers = _named(np.array(names), np.array(by_substring), np.array(leftmost)).tolist()
    named = dict(zip(by_substring, numbers, strict=True))
    shorter = _sort_names([named[place] for place in leftmost])
    return induce([leftmost[i] for i in shorter])


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Order of the suffixes of ``text``, whose last symbol, 0, stands nowhere else."""
    if len(text) == 1:
        return np.zeros(1, dtype=np.int64)
    smaller = _smaller(text)
    leftmost = _leftmost(smaller)
    isleft = np.zeros(len(text), dtype=bool)
    isleft[leftmost] = True
    rough = _induce(text, smaller, leftmost, symbols)
    by_substring = rough[isleft[rough]]
    numbers = _named(text, by_substring, leftmost)
    if numbers[-1] + 1 < len(leftmost):
        named = np.empty(len(text), dtype=np.int64)
        named[by_substring] = numbers
        by_substring = leftmost[np.array(_sort_names(named[leftmost].tolist()))]
    return _induce(text, smaller, by_substring, symbols)


def common_prefixes(text: np.ndarray, order: np.ndarray, breaks: int) -> np.ndarray:
    """Permuted common prefixes: for each place the number of symbols that its suffix shares
    with the one before it in ``order``, up to a symbol of at most ``breaks``.

    A place whose symbol to the left is that of its partner's has one less than the place
    before; only the others are compared, and the rest follows.
    """
    n = len(text)
    partner = np.full(n, -1, dtype=np.int64)
    partner[order[1:]] = order[:-1]
    place = np.arange(n)
    own = np.ones(n, dtype=bool)
    own[1:] = (
        (partner[1:] < 1) | (text[partner[1:] - 1] != text[:-1]) | (text[:-1] <= breaks)
    )
    own[np.flatnonzero(partner < 0)] = True
    after_none = np.flatnonzero(partner < 0) + 1
    own[after_none[after_none < n]] = True
    shared = np.zeros(n, dtype=np.int64)
    left = np.flatnonzero(own & (partner >= 0))
    at = 0
    while len(left):
        symbols = text[np.minimum(left + at, n - 1)]
        equal = (symbols > breaks) & (symbols == text[np.minimum(partner[left] + at, n - 1)])
        left = left[equal]
        shared[left] += 1
        at += 1
    last = np.maximum.accumulate(np.where(own, place, 0))
    return np.maximum(shared[last] - (place - last), 0)
