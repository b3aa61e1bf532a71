"""Array scalars over score vectors: softmax, arg-max, top-k, dot products."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_max_value(c) -> Column:
    return F.array_max(_col(c))


def _with_scalar(arr: Column, scalar: Column, fn) -> Column:
    """``fn(x, s)`` per element with ``s`` evaluated once per row.

    A scalar written inside a lambda is re-evaluated for every element; pairing
    the array with ``array_repeat(s, n)`` evaluates it once.
    """
    return F.zip_with(arr, F.array_repeat(scalar, F.size(arr)), fn)


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def softmax(c) -> Column:
    """Numerically stable softmax of a DOUBLE array."""
    z = _col(c)
    e = _with_scalar(z, F.array_max(z), lambda x, m: F.exp(x - m))
    return _normalise(e)


def _normalise(arr: Column) -> Column:
    return _with_scalar(arr, _sum(arr), lambda x, t: x / t)


def argmax(c) -> Column:
    """0-based index of the first maximum."""
    p = _col(c)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def top_k(c, k: int) -> Column:
    """Top-k ``struct(idx, p)`` by probability desc, ties to the lower index."""
    p = _col(c)
    pairs = F.transform(p, lambda x, i: F.struct(i.alias("idx"), x.alias("p")))
    ordered = F.array_sort(
        pairs,
        lambda a, b: F.when(a["p"] > b["p"], -1).when(a["p"] < b["p"], 1)
        .when(a["idx"] < b["idx"], -1).when(a["idx"] > b["idx"], 1).otherwise(0),
    )
    return F.slice(ordered, 1, k)


def dot_rows(weights, x) -> Column:
    """``W . x`` for W an array of weight rows: one DOUBLE per row."""
    xv = _col(x)
    return F.transform(
        _col(weights),
        lambda w: F.aggregate(F.zip_with(w, xv, lambda a, b: a * b),
                              F.lit(0.0).cast("double"), lambda acc, y: acc + y),
    )


def sigmoid_normalised(c) -> Column:
    """One-vs-rest probabilities: per-class sigmoid, divided by their sum."""
    s = F.transform(_col(c), lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(-x)))
    return _normalise(s)
