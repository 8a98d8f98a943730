"""Dictionaries against text: an Aho-Corasick automaton in a packed double array, run over whole Arrow columns at once.

A state is a slot of the arrays; the child of state s by byte b stands at base[s] + b if check[] of that slot is s. Where a
state has no such child, its failure link names the longest suffix that is a state. States with several children get a span of
slots each, those with one child the gaps in between, so the arrays have few more slots than states; they are built level by
level with array operations. A text is read once whatever the number of words.

Reading is sequential by nature, so columns are laid out as lanes: the bytes of a piece, with a separator after each text,
are cut into equal chunks, and all chunks advance by one byte at a time. A lane starts as many bytes early as the longest word
has, less one, and gives the words that end in its chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of a chunk at least, and of the texts that are laid out at once, about.
CHUNK, PIECE = 512, 4 << 20
#: Bytes of all words together up to which one automaton is made: its arrays take about 20 bytes for each.
MOST_BYTES = 64 << 20
SEPARATOR = 0xFF  # in no UTF-8 text
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


class Automaton:
    """Finds all occurrences of words (strings; empty ones are never found), overlapping ones included. fold: ASCII letters match
    in either case. Memory: about 20 bytes for each byte of the words, so that it can go to every task; words of more than
    MOST_BYTES in all are an error."""

    def __init__(self, words: list[str], fold: bool = False):
        self.fold = fold
        raw = [w.encode() for w in words]
        if sum(map(len, raw)) > MOST_BYTES:
            raise ValueError(f"words of more than {MOST_BYTES} bytes don't make one automaton")
        if fold:
            raw = [w.translate(_FOLD.tobytes()) for w in raw]
        order = sorted((i for i in range(len(raw)) if raw[i]), key=raw.__getitem__)
        length = np.array([len(raw[i]) for i in order], np.int64)
        self.longest = int(length.max()) if len(order) else 0
        data = np.frombuffer(b"".join(raw[i] for i in order), np.uint8)
        start = np.cumsum(length) - length
        # nodes level by level: words are sorted, so those with a prefix in common stand together
        node = np.zeros(len(order), np.int64)
        parents, bytes_, levels = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [0, 1]
        live = np.arange(len(order))
        for d in range(self.longest):
            live = live[length[live] > d]
            byte = data[start[live] + d]
            new = np.r_[True, (node[live][1:] != node[live][:-1]) | (byte[1:] != byte[:-1])]
            parents.append(node[live][new])
            bytes_.append(byte[new].astype(np.int64))
            node[live] = levels[-1] + np.cumsum(new) - 1
            levels.append(levels[-1] + int(new.sum()))
        parent, byte = np.concatenate(parents), np.concatenate(bytes_)
        slot = self._place(parent, byte)
        size = int(slot.max()) + 257
        self.check = np.full(size, -1, np.int32)
        self.check[slot[1:]] = slot[parent[1:]]
        self.base = np.zeros(size, np.int32)
        self.base[slot[parent[1:]]] = slot[1:] - byte[1:]
        self.base[slot[np.bincount(parent[1:], minlength=len(parent)) == 0]] = 0
        # words by the state at their end; equal words (after folding) share one
        self.ends = np.full(size, -1, np.int32)
        place = slot[node]
        new = np.r_[True, place[1:] != place[:-1]][: len(place)]
        self.ends[place[new]] = np.arange(int(new.sum()))
        self.length = length[new].astype(np.int32)
        first = np.flatnonzero(new)
        self.members = [order[i:j] for i, j in zip(first, [*first[1:], len(order)], strict=False)]
        self.fail, self.next_end = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        for a, b in zip(levels[2:-1], levels[3:], strict=True):  # from the children's children on; the first level fails to the root
            s, p, c = slot[a:b], slot[parent[a:b]], byte[a:b]
            self.fail[s] = self._step(self.fail[p], c)
            f = self.fail[s]
            self.next_end[s] = np.where(self.ends[f] >= 0, f, self.next_end[f])
        self.hit = (self.ends >= 0) | (self.next_end >= 0)

    @staticmethod
    def _place(parent: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The slot of each node; the root has 0. Children are in order of parent, then byte."""
        slot = np.zeros(len(parent), np.int64)
        if len(parent) == 1:
            return slot
        children = np.bincount(parent[1:], minlength=len(parent))
        first = 1 + np.flatnonzero(np.r_[True, parent[2:] != parent[1:-1]])
        count = children[parent[first]]
        many = first[count > 1]
        width = byte[many + children[parent[many]] - 1] - byte[many] + 1
        at = 256 + np.cumsum(width) - width  # a base is never negative
        own = np.repeat(np.arange(len(many)), children[parent[many]])
        rows = np.repeat(many, children[parent[many]]) + np.arange(len(own)) - np.searchsorted(own, own)
        slot[rows] = at[own] + byte[rows] - byte[many][own]
        single = first[count == 1]
        free = np.ones(256 + int(width.sum()) + len(single), bool)
        free[:256] = False
        free[slot[rows]] = False
        slot[single] = np.flatnonzero(free)[: len(single)]
        return slot

    def _step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The states after one byte each."""
        new = self.base[state] + byte
        wrong = np.flatnonzero(self.check[new] != state)
        up = state[wrong]
        while len(wrong):
            root = up == 0
            new[wrong[root]] = 0
            wrong, up = wrong[~root], self.fail[up[~root]]
            t = self.base[up] + byte[wrong]
            good = self.check[t] == up
            new[wrong[good]] = t[good]
            wrong, up = wrong[~good], up[~good]
        return new

    def _scan(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last byte, state) of each place in data where a word ends."""
        n, warm = len(data), max(self.longest - 1, 0)
        chunk = max(CHUNK, 8 * self.longest)
        lanes = -(-n // chunk)
        padded = np.full(warm + lanes * chunk, SEPARATOR, np.uint8)
        padded[warm : warm + n] = data
        rows = np.ascontiguousarray(np.lib.stride_tricks.as_strided(padded, (lanes, warm + chunk), (chunk, 1)).T)
        state = np.zeros(lanes, np.int32)
        where, found = [], []
        for k in range(warm + chunk):
            state = self._step(state, rows[k])
            if k >= warm:
                at = np.flatnonzero(self.hit[state])
                if len(at):
                    where.append(at * chunk + (k - warm))
                    found.append(state[at])
        if not where:
            return np.empty(0, np.int64), np.empty(0, np.int32)
        return np.concatenate(where), np.concatenate(found)

    def find(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each piece of a string column: its first row, its bytes, where each of its texts begins in them (and one more),
        and of each occurrence, sorted by row and start, then length: row in the piece, start in the bytes, number of the word
        (an index of `members`, which gives the words' own numbers)."""
        for first, data, begin in pieces(column):
            last, state = self._scan(_FOLD[data] if self.fold else data) if self.longest else (np.empty(0, np.int64), np.empty(0, np.int32))
            starts, words = [], []
            while len(state):
                own = self.ends[state] >= 0
                word = self.ends[state[own]]
                starts.append(last[own] - self.length[word] + 1)
                words.append(word)
                state = self.next_end[state]
                last, state = last[state >= 0], state[state >= 0]
            start = np.concatenate(starts) if starts else np.empty(0, np.int64)
            word = np.concatenate(words) if words else np.empty(0, np.int32)
            order = np.lexsort((self.length[word], start))
            start, word = start[order], word[order]
            yield first, data, begin, np.searchsorted(begin, start, "right") - 1, start, word


def pieces(column: pa.Array, most: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a string column in pieces of about `most` bytes (a longer text is one by itself): first row, bytes with a
    separator after each text, and where each text begins, with the end of all. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8) if n else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1))
        size = np.diff(at[i : j + 1])
        begin = np.r_[0, np.cumsum(size + 1)]
        data = np.full(int(begin[-1]), SEPARATOR, np.uint8)
        solid = np.ones(len(data), bool)
        solid[begin[1:] - 1] = False
        data[solid] = raw[at[i] : at[j]]
        yield i, data, begin
        i = j


def edged(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether no ASCII letter stands before start or from end on."""
    before = np.where(start > 0, LETTER[data[np.maximum(start - 1, 0)]], False)
    return ~before & ~LETTER[data[np.minimum(end, len(data) - 1)]]
