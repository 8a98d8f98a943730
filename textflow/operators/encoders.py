"""Text encoders by name, applied once for each distinct text; vectors are kept as a table."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textflow.operators.lookup import once_for_each


class Encoder(Protocol):
    """Texts to rows of a float matrix. Made anew in each task, so a model is loaded once there."""

    def encode(self, texts: list[str]) -> np.ndarray: ...


class Hashed:
    """Character trigrams hashed into a vector of fixed size, normalised: no model needed. A trigram is hashed once, when it is
    first met; after that its place comes from a table."""

    #: Trigrams outside ASCII that are kept, and what stands for no character (in texts of under three).
    KEPT, NONE = 1 << 20, 0x1FFFFF

    def __init__(self, size: int = 64):
        self.size = size
        self.ascii = np.full(1 << 21, -1, np.int32)
        self.others: dict[int, int] = {}

    def _hash(self, key: int) -> int:
        gram = "".join(chr(c) for c in (key >> 42, key >> 21 & self.NONE, key & self.NONE) if c != self.NONE)
        return int.from_bytes(hashlib.blake2b(gram.lower().encode(), digest_size=4).digest(), "little") % self.size

    def _places(self, grams: np.ndarray) -> np.ndarray:
        """The place of each trigram (three code points a row)."""
        out = np.empty(len(grams), np.int64)
        plain = (grams < 128).all(axis=1)
        short = grams[plain] @ np.array([1 << 14, 1 << 7, 1])
        for k in np.unique(short[self.ascii[short] < 0]).tolist():
            self.ascii[k] = self._hash((k >> 14) << 42 | (k >> 7 & 127) << 21 | k & 127)
        out[plain] = self.ascii[short]
        keys, at = np.unique(grams[~plain] @ np.array([1 << 42, 1 << 21, 1]), return_inverse=True)
        if len(self.others) > self.KEPT:
            self.others.clear()
        known = self.others
        for k in keys.tolist():
            if k not in known:
                known[k] = self._hash(k)
        out[~plain] = np.array([known[k] for k in keys.tolist()], np.int64)[at]
        return out

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size))
        for row, text in zip(out, texts, strict=True):
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
            codes = np.concatenate([codes, np.full(max(0, 3 - len(codes)), self.NONE)])
            for i in range(0, len(codes) - 2, 1 << 20):
                grams = np.lib.stride_tricks.sliding_window_view(codes[i : i + (1 << 20) + 2], 3)
                row += np.bincount(self._places(grams), minlength=self.size)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


class Counted:
    """An encoder with three outputs: dense (as Hashed), sparse (counts of lower-case ASCII words) and multi (a dense vector for
    each of a text's words, whole texts)."""

    def __init__(self, size: int = 64):
        self.dense = Hashed(size)

    def encode(self, texts: list[str]) -> np.ndarray:
        return self.dense.encode(texts)

    def parts(self, texts: list[str], wanted: tuple[str, ...]) -> dict[str, list]:
        words = [re.findall("[a-z]+", t.lower()) for t in texts]
        made = {"dense": lambda: self.dense.encode(texts).tolist(), "sparse": lambda: [{w: float(n) for w, n in Counter(ws).items()} for ws in words], "multi": lambda: [self.dense.encode(ws).tolist() for ws in words]}
        return {name: made[name]() for name in wanted}


REGISTRY: dict[str, Callable[..., Encoder]] = {"hashed": Hashed, "counted": Counted}


def register(name: str, make: Callable[..., Encoder]) -> None:
    REGISTRY[name] = make


def create(name: str, **config) -> Encoder:
    if name not in REGISTRY:
        raise ValueError(f"no encoder {name!r}; there are {sorted(REGISTRY)}")
    return REGISTRY[name](**config)


def encode(df: DataFrame, column: str, name: str, batch: int = 64, done: DataFrame | None = None, **config) -> DataFrame:
    """df with `vector`, encoding each distinct text that `done` (column, vector) doesn't have, `batch` at a time."""
    if name not in REGISTRY:
        raise ValueError(f"no encoder {name!r}; there are {sorted(REGISTRY)}")
    make = REGISTRY[name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make(**config)
        for rows in batches:
            for i in range(0, rows.num_rows, batch):
                part = rows.column(0).slice(i, batch)
                made = np.asarray(encoder.encode(part.to_pylist()), np.float64)
                ends = np.arange(len(made) + 1, dtype=np.int32) * made.shape[1]
                yield pa.RecordBatch.from_arrays([part, pa.ListArray.from_arrays(ends, made.ravel())], [column, "vector"])

    return once_for_each(df, column, lambda todo: todo.mapInArrow(run, f"`{column}` string, vector array<double>"), done)


PARTS = {"dense": "array<double>", "sparse": "map<string, double>", "multi": "array<array<double>>"}


def encode_parts(df: DataFrame, column: str, name: str, wanted: tuple[str, ...] = ("dense", "sparse", "multi"), batch: int = 64, done: DataFrame | None = None, **config) -> DataFrame:
    """df with the outputs that are wanted (see PARTS) of an encoder that has parts(), made once for each distinct text."""
    if name not in REGISTRY:
        raise ValueError(f"no encoder {name!r}; there are {sorted(REGISTRY)}")
    make = REGISTRY[name]
    kinds = {"dense": pa.list_(pa.float64()), "sparse": pa.map_(pa.string(), pa.float64()), "multi": pa.list_(pa.list_(pa.float64()))}

    def run(batches):
        encoder = make(**config)
        for rows in batches:
            for i in range(0, rows.num_rows, batch):
                part = rows.slice(i, batch)
                made = encoder.parts(part.column(0).to_pylist(), wanted)
                columns = [pa.array([list(x.items()) for x in made[w]] if w == "sparse" else made[w], kinds[w]) for w in wanted]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], [column, *wanted])

    schema = ", ".join([f"`{column}` string", *(f"{w} {PARTS[w]}" for w in wanted)])
    return once_for_each(df, column, lambda todo: todo.mapInArrow(run, schema), done)
