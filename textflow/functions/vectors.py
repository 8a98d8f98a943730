"""Vector functions over array<double> columns, without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def normalized(a: Column, floor: float = 1e-12) -> Column:
    """a scaled to length 1; the norm counts as `floor` at least."""
    n = F.greatest(norm(a), F.lit(floor))
    return F.transform(a, lambda x: x / n)


def multi(query: Column, doc: Column) -> Column:
    """Late interaction: mean over the query's vectors of the best dot product with one of the document's."""
    best = F.transform(query, lambda q: F.array_max(F.transform(doc, lambda d: dot(q, d))))
    return F.aggregate(best, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.size(query), F.lit(1))


def split(a: Column, parts: int, width: int) -> Column:
    """A flat vector as `parts` vectors of `width` values."""
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.slice(a, i * width + 1, F.lit(width)))


def weighted(scores: list[Column], weights: list[float]) -> Column:
    out = F.lit(0.0)
    for score, weight in zip(scores, weights, strict=True):
        out = out + F.coalesce(score, F.lit(0.0)) * F.lit(float(weight))
    return out
