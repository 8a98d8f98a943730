"""Dictionaries of any size against texts: names masked, and groups of trigger words found, in one pass over the text.

The automaton is made once on the driver and goes to every task as a broadcast variable; it takes about 20 bytes for each byte
of the words, and more words than automaton.MOST_BYTES are an error. The plan is one projection whatever their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.functions.automaton import LETTER, Automaton, edged

MARK = re.compile(r"<ENT_\d{2,}>")
MASKED = "struct<masked: string, found: array<string>>"
MASKED_TYPE = pa.struct([("masked", pa.string()), ("found", pa.list_(pa.string()))])
LOST_TYPE = pa.struct([("missing", pa.list_(pa.string())), ("aliased", pa.list_(pa.string()))])
#: Rows that are Python objects at a time, at most.
ROWS = 256


def _joined(pieces: Iterator[pa.Array], kind: pa.DataType) -> pa.Array:
    """Pieces as one array: only a piece at a time is there as Python objects, whatever the size of the batch."""
    return pa.concat_arrays(list(pieces) or [pa.array([], kind)])


def needs_edges(word: str) -> bool:
    """Short or all-capital names count only where no Latin letter stands beside them."""
    return len(word) <= 4 or word.isupper()


def masking_order(names: Iterable[str]) -> list[str]:
    """Names by length, longest first, then by name: the order in which they claim their places; empty ones are left out."""
    return sorted({n for n in names if n}, key=lambda n: (-len(n), n))


class Mask:
    """Replaces names (in any ASCII case) by marks. A name claims its places from left to right, names that come first in `names`
    before others; places that overlap a claimed one are lost, and a claimed one beside a place counts as no letter."""

    def __init__(self, names: list[str], form: str = "<ENT_{:02d}>"):
        self.names, self.marks = names, [form.format(i).encode() for i in range(len(names))]
        self.automaton = Automaton(names, fold=True)
        # names that are equal but for case are one word of the automaton; the first of them takes its places
        rank = [min(m) for m in self.automaton.members]
        self.rank = np.array(rank, np.int64)
        self.edges = np.array([[needs_edges(names[i]) for i in m] for m in self.automaton.members], object)

    def _claims(self, data: np.ndarray, low: int, high: int, start: np.ndarray, word: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, rank) of the claimed places of one text, bytes low to high of data, in order of place; start and word:
        its occurrences."""
        todo = sorted((i, int(s), int(self.automaton.length[w]), needs) for s, w in zip(start, word, strict=True) for i, needs in zip(self.automaton.members[w], self.edges[w], strict=True))
        owner = np.full(high - low + 2, -1, np.int64)  # of the byte before the text, its bytes and the one after it
        out = []
        for i, s, n, needs in todo:
            a = s - low + 1
            if (owner[a : a + n] >= 0).any():
                continue
            if needs and (LETTER[data[s - 1]] and s > low and owner[a - 1] in (-1, i) or LETTER[data[s + n]] and s + n < high and owner[a + n] in (-1, i)):
                continue
            owner[a : a + n] = i
            out.append((s, s + n, i))
        return sorted(out)

    def __call__(self, column: pa.Array) -> pa.Array:
        return _joined(self.pieces(column), MASKED_TYPE)

    def pieces(self, column: pa.Array) -> Iterator[pa.Array]:
        for _, data, begin, row, start, word in self.automaton.find(column):
            texts: list[bytes] = []
            found: list[list[str]] = []
            raw = data.tobytes()
            edge = np.searchsorted(row, np.arange(len(begin)))
            for k in range(len(begin) - 1):
                low, high = int(begin[k]), int(begin[k + 1]) - 1
                i, j = edge[k], edge[k + 1]
                if i == j:
                    texts.append(raw[low:high])
                    found.append([])
                    continue
                claims, at, parts = self._claims(data, low, high, start[i:j], word[i:j]), low, []
                for s, e, name in claims:
                    parts += [raw[at:s], self.marks[name]]
                    at = e
                texts.append(b"".join([*parts, raw[at:high]]))
                found.append([self.names[x] for x in sorted({c[2] for c in claims})])
            masked = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.StructArray.from_arrays([masked, pa.array(found, pa.list_(pa.string()))], ["masked", "found"])


class Unmask:
    """Replaces the marks of Mask by the names again."""

    def __init__(self, names: list[str]):
        self.names = {f"<ENT_{i:02d}>": n for i, n in enumerate(names)}

    def __call__(self, column: pa.Array) -> pa.Array:
        return _joined(self.pieces(column), pa.string())

    def pieces(self, column: pa.Array) -> Iterator[pa.Array]:
        for i in range(0, len(column), ROWS):
            yield pa.array([MARK.sub(lambda m: self.names.get(m[0], m[0]), t) for t in column.slice(i, ROWS).to_pylist()], pa.string())


class Groups:
    """Tells which groups have a word in a text, in the order of the groups. groups: name -> words (empty ones are never found);
    edges: whether a word counts only where no Latin letter stands beside it."""

    def __init__(self, groups: dict[str, list[str]], edges=lambda word: False):
        pairs = [(w, g) for g, ws in enumerate(groups.values()) for w in ws]
        self.names = list(groups)
        self.automaton = Automaton([w for w, _ in pairs])
        of = [sorted({pairs[i][1] for i in m}) for m in self.automaton.members]
        self.size = np.array([len(x) for x in of], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.group = np.array([g for x in of for g in x], np.int64)
        self.edges = np.array([edges(pairs[m[0]][0]) for m in self.automaton.members], bool)

    def __call__(self, column: pa.Array) -> pa.Array:
        return _joined(self.pieces(column), pa.list_(pa.string()))

    def pieces(self, column: pa.Array) -> Iterator[pa.Array]:
        for _, data, begin, row, start, word in self.automaton.find(column):
            good = ~self.edges[word] | edged(data, start, start + self.automaton.length[word])
            row, word = row[good], word[good]
            n = self.size[word]
            at = np.repeat(self.first[word] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            pairs = np.unique(np.repeat(row, n) * len(self.names) + self.group[at])
            edge = np.searchsorted(pairs, np.arange(len(begin)) * len(self.names))
            chosen = [self.names[g] for g in (pairs % max(len(self.names), 1)).tolist()]
            yield pa.array([chosen[i:j] for i, j in zip(edge[:-1], edge[1:], strict=True)], pa.list_(pa.string()))


class Lost:
    """Of the names (in an order of their own) that a list says a text should have, those that it hasn't in any case: without an
    alias either (missing), or with one (aliased)."""

    def __init__(self, names: list[str], aliases: dict[str, list[str]]):
        self.rank = {n: i for i, n in enumerate(names)}
        own = {f"n{n}": [n.lower()] for n in names}
        self.groups = Groups(own | {f"a{n}": [a.lower() for a in aliases[n]] for n in names if n in aliases})

    def __call__(self, wanted: pa.Array, column: pa.Array) -> pa.Array:
        there = self.groups(column)
        return _joined((self._piece(wanted.slice(i, ROWS), there.slice(i, ROWS)) for i in range(0, len(column), ROWS)), LOST_TYPE)

    def _piece(self, wanted: pa.Array, found: pa.Array) -> pa.Array:
        missing, aliased = [], []
        for names, there in zip(wanted.to_pylist(), found.to_pylist(), strict=True):
            there = set(there)
            lost = [n for n in sorted({*(names or ())} & self.rank.keys(), key=self.rank.get) if f"n{n}" not in there]
            missing.append([n for n in lost if f"a{n}" not in there])
            aliased.append([n for n in lost if f"a{n}" in there])
        return pa.StructArray.from_arrays([pa.array(x, pa.list_(pa.string())) for x in (missing, aliased)], ["missing", "aliased"])


def _applied(matcher, kind: str, *columns: Column) -> Column:
    """An Arrow function with the matcher in a broadcast variable."""
    shared = SparkSession.active().sparkContext.broadcast(matcher)

    def one(column: pa.Array) -> pa.Array:
        return shared.value(column)

    def two(first: pa.Array, second: pa.Array) -> pa.Array:
        return shared.value(first, second)

    return F.arrow_udf(one if len(columns) == 1 else two, kind)(*columns)


def _streamed(matcher, kind: str, column: Column) -> Column:
    """As _applied(), the pieces handed on as they are made: no second copy of a batch's texts. Such a function has a Python
    process of its own in each task."""
    shared = SparkSession.active().sparkContext.broadcast(matcher)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield from shared.value.pieces(column)

    return F.arrow_udf(run, kind)(column)


def masked(c: Column, names: list[str], streamed: bool = True) -> Column:
    """A text (null: empty) with names replaced by <ENT_nn>, nn their place in `names`, as (masked, found): found are the names that
    were replaced, in the same order. streamed: for long texts; if not, it shares a process with other functions of a dictionary."""
    return (_streamed if streamed else _applied)(Mask(names), MASKED, F.coalesce(c, F.lit("")))


def unmasked(c: Column, names: list[str]) -> Column:
    """A text (null: empty) with the marks of masked() replaced by the names."""
    return _streamed(Unmask(names), "string", F.coalesce(c, F.lit("")))


def groups_in(c: Column, groups: dict[str, list[str]], edges=lambda word: False) -> Column:
    """The groups that have a word in a text (null: none), as an array in the order of `groups`. Letters match as they are."""
    return _applied(Groups(groups, edges), "array<string>", F.coalesce(c, F.lit("")))


def lost_names(wanted: Column, low: Column, names: list[str], aliases: dict[str, list[str]]) -> Column:
    """wanted (array of names) and a lower-case text -> (missing, aliased) as Lost() has them, in the order of `names`."""
    return _applied(Lost(names, aliases), "struct<missing: array<string>, aliased: array<string>>", wanted, F.coalesce(low, F.lit("")))


def names_of(table: DataFrame, column: str = "name") -> list[str]:
    """The distinct names of a dictionary that is a table, for masked() and groups_in(); sizes are checked before they come here."""
    from textflow.functions.automaton import MOST_BYTES

    names = table.select(F.col(column).alias("name")).where("name <> ''").distinct()
    size = names.agg(F.coalesce(F.sum(F.octet_length("name")), F.lit(0))).first()[0]
    if size > MOST_BYTES:
        raise ValueError(f"names of {size} bytes, over {MOST_BYTES}, don't make one automaton")
    return masking_order(r.name for r in names.toLocalIterator())
