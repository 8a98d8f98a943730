"""Ratcliff-Obershelp similarity as difflib defines it, without its quadratic search.

difflib takes the longest run that two texts share, extends it, and goes on left and right of it. Characters of the second text
that make up over 1 in 100 of 200 or more ("popular") begin no run; they only extend one. Here all regions are searched at once,
longest runs first: a run of one length is an integer (ranks of runs of 1, 2, 4, ... characters by doubling), so that runs
shared within a region are those with equal (region, integer) on both sides. Left of the first run of the greatest length
there are only shorter ones, so one sweep from left to right takes all runs of that length, and each length that occurs takes
one sweep. The work is n log n for each of them; they add up to no more than the text.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class _Runs:
    """The two texts as one sequence with a gap between them, and which stretches of both (regions) still belong together."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.gap, n = len(a), len(a) + 1 + len(b)
        _, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
        there = np.bincount(codes[len(a) :], minlength=int(codes.max()) + 1)
        rare = (there > 0) & (there <= (len(b) // 100 + 1 if len(b) >= 200 else len(b)))
        self.n, good = n, np.zeros(n, bool)
        ids = np.zeros(n, np.int64)
        ids[: len(a)], ids[len(a) + 1 :] = codes[: len(a)], codes[len(a) :]
        good[: len(a)], good[len(a) + 1 :] = rare[codes[: len(a)]], rare[codes[len(a) :]]
        at = np.arange(n)
        stop = np.minimum.accumulate(np.where(good, n, at)[::-1])[::-1]
        self.run, self.at, self.ranks = stop - at, at, [ids]  # run: characters that may be part of a run from here on
        self.deal([(0, len(a), len(a) + 1, n)])

    def deal(self, regions: list[tuple[int, int, int, int]]) -> None:
        """regions: (begin, end) in the first text and (begin, end) in the second, as places of the sequence."""
        self.regions = regions
        places = np.array(regions, np.int64).reshape(-1, 2)
        size = places[:, 1] - places[:, 0]
        begin = np.cumsum(size) - size
        self.place = np.arange(int(size.sum())) + np.repeat(places[:, 0] - begin, size)
        self.own = np.repeat(np.arange(len(places)) // 2, size)
        self.room = np.minimum(self.run[self.place], np.repeat(places[:, 1], size) - self.place)
        alive = self.room > 0
        self.place, self.own, self.room = self.place[alive], self.own[alive], self.room[alive]

    def _rank(self, level: int) -> np.ndarray:
        while len(self.ranks) <= level:
            half, last = 1 << (len(self.ranks) - 1), self.ranks[-1]
            at = np.flatnonzero(self.run >= 2 * half)
            new = np.zeros(self.n, np.int64)
            new[at] = np.unique(last[at] * self.n + last[at + half], return_inverse=True)[1]
            self.ranks.append(new)
        return self.ranks[level]

    def shared(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(places, keys) of the first text's runs of a length that their region's second text has too, by place, and those of
        the second text, by key, then place."""
        some = self.room >= length
        place, own = self.place[some], self.own[some]
        level = length.bit_length() - 1
        rank = self._rank(level)
        run = rank[place]
        if length != 1 << level:
            run = np.unique(run * self.n + rank[place + length - (1 << level)], return_inverse=True)[1]
        key, left = own * self.n + run, place < self.gap
        one, two = key[left], key[~left]
        hit = np.isin(one, two)
        order = np.argsort(two, kind="stable")
        first = place[left][hit]
        return (*((x[o] for o in [np.argsort(first)] for x in (first, one[hit]))), place[~left][order], two[order])


def _longest(runs: _Runs, most: int):
    """(length, shared(length)) of the greatest length up to `most` that is shared, or None. What is shared at a length is so at
    smaller ones."""
    best, low, high, step = None, 0, most + 1, 1
    while high - low > 1:
        length = min(low + step, high - 1)
        found = runs.shared(length)
        if len(found[0]):
            best, low, step = (length, found), length, 2 * step
        else:
            high, step = length, max(1, (length - low) // 2)
    return best


def matched(a: str, b: str) -> int:
    """The characters that difflib.SequenceMatcher(None, a, b) finds in both texts, in order."""
    if not a or not b:
        return 0
    runs, text, total = _Runs(_codes(a), _codes(b)), f"{a}\0{b}", 0
    most = int(runs.room.max(initial=0))
    while most and (found := _longest(runs, most)):
        length, (first, keys, second, names) = found
        low, high = np.searchsorted(names, keys).tolist(), np.searchsorted(names, keys, "right").tolist()
        second, left = second.tolist(), []
        now = runs.regions
        for i, r, x, y in zip(first.tolist(), (keys // runs.n).tolist(), low, high, strict=True):
            begin, end, start, stop = now[r]
            if i < begin or (k := bisect_left(second, start, x, y)) == y:
                continue
            j, e = second[k], i + length
            f = j + length
            while i > begin and j > start and text[i - 1] == text[j - 1]:
                i, j = i - 1, j - 1
            while e < end and f < stop and text[e] == text[f]:
                e, f = e + 1, f + 1
            total += e - i
            left.append((begin, i, start, j))
            now[r] = e, end, f, stop
        runs.deal([x for x in (*left, *now) if x[0] < x[1] and x[2] < x[3]])
        most = min(length, int(runs.room.max(initial=0)))
        most = most - 1 if most == length else most
    for i, end, j, stop in runs.regions:  # what begins alike without a run
        while i < end and j < stop and text[i] == text[j]:
            i, j, total = i + 1, j + 1, total + 1
    return total


def ratio(a: str, b: str) -> float:
    """difflib.SequenceMatcher(None, a, b).ratio()"""
    return 2.0 * matched(a, b) / (len(a) + len(b)) if a or b else 1.0
