"""Jaro similarity (UDF1) as an Arrow-batched pandas UDF.

Spark has no built-in Jaro; the standard algorithm: characters match when equal and
at most ``max(len) // 2 - 1`` positions apart; with m matches and t half (rounded
down) the number of matched characters out of order, similarity = (m/|a| + m/|b| + (m - t)/m) / 3.
Two empty strings, or one, score 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from unitmesh.session import ship_package

# Cells (pairs x characters) compared at once.
_CELLS = 1 << 20
# Pairs from which a block ends where the matching window does.
_ALIKE = 512


def _codes(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points plus two as a padded matrix of the narrowest type, and the lengths."""
    size = np.array([len(t) for t in texts])
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint32(2)
    out = np.full((len(texts), int(size.max(initial=0))), pad, np.min_scalar_type(int(flat.max(initial=2))))
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = flat
    return out, size


def _in_order(codes: np.ndarray, taken: np.ndarray, n: int) -> np.ndarray:
    """The taken characters of each row, moved to its front."""
    return np.take_along_axis(codes, np.argsort(~taken, axis=1, kind="stable"), axis=1)[:, :n]


def _jaro_block(left: list[str], right: list[str]) -> np.ndarray:
    a, la = _codes(left, 1)
    b, lb = _codes(right, 0)
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    widest, rows = int(window.max(initial=0)), np.arange(len(a))
    alike = bool((window == widest).all())
    took_a, free_b = np.zeros(a.shape, bool), b.copy()  # taken characters become padding
    for i in range(a.shape[1]):
        lo, hi = max(0, i - widest), min(b.shape[1], i + widest + 1)
        if lo >= hi:
            break
        free = free_b[:, lo:hi] == a[:, i, None]
        if not alike:
            free &= np.abs(np.arange(lo, hi)[None, :] - i) <= window[:, None]
        first = free.argmax(axis=1)
        hit = free[rows, first]
        took_a[:, i] = hit
        free_b[rows[hit], lo + first[hit]] = 0
    took_b = free_b != b
    m = took_a.sum(axis=1)
    n = int(m.max(initial=0))
    differ = (_in_order(a, took_a, n) != _in_order(b, took_b, n)) & (np.arange(n)[None, :] < m[:, None])
    t = differ.sum(axis=1) // 2
    some = np.maximum(m, 1)
    return np.where(m > 0, (m / np.maximum(la, 1) + m / np.maximum(lb, 1) + (m - t) / some) / 3, 0.0)


def jaro_many(left: list[str], right: list[str]) -> np.ndarray:
    """Jaro similarities of the pairs of two equally long lists, many pairs at a time."""
    size = np.array([max(len(a), len(b), 1) for a, b in zip(left, right)])
    order = np.argsort(size, kind="stable")  # pairs of like length together: little padding
    size, out = size[order], np.zeros(len(size))
    window = size // 2
    lo = 0
    while lo < len(order):
        cells = np.arange(1, min(len(size) - lo, _CELLS // size[lo]) + 1) * size[lo:lo + _CELLS // size[lo]]
        hi = lo + max(1, int(np.searchsorted(cells, _CELLS, "right")))
        if hi - lo > _ALIKE:  # enough pairs of one window
            hi = min(hi, int(np.searchsorted(window, window[lo + _ALIKE - 1], "right")))
        at = order[lo:hi]
        out[at] = _jaro_block([left[i] for i in at], [right[i] for i in at])
        lo = hi
    return out


def jaro(a: str | None, b: str | None) -> float | None:
    return None if a is None or b is None else float(jaro_many([a], [b])[0])


@F.pandas_udf(T.DoubleType())
def _jaro_udf(left: pd.Series, right: pd.Series) -> pd.Series:
    out = np.full(len(left), None, object)
    both = (left.notna() & right.notna()).to_numpy()
    out[both] = jaro_many(left[both].tolist(), right[both].tolist())
    return pd.Series(out)


def jaro_similarity(left: Column, right: Column) -> Column:
    """Jaro similarity in [0, 1] of two string columns (NULL if either is NULL)."""
    ship_package()
    return _jaro_udf(left, right)


def match_score(left: Column, right: Column, digits: int = 6) -> Column:
    """SCL13: similarity x 100 (rounded); the reference calls it a full match only at 100."""
    return F.round(jaro_similarity(left, right) * 100, digits)
