"""Similarity of names, 0 to 100: the best ratio over shared and unshared words."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence: rows as the bits of one number."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    ones = row = (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & ones
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * common_length(a, b) / (len(a) + len(b))


def token_set_ratio(a: str | None, b: str | None) -> float:
    """0 if either has no word."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_x or not only_y):
        return 100.0
    left, right = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    best = ratio(left, right)
    return max(best, ratio(both, left), ratio(both, right)) if both else best


def name_similarity(a: Column, b: Column) -> Column:
    """Arrow batches; use it on the few pairs that a join in space has left."""

    @F.pandas_udf("double")
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([token_set_ratio(p, q) for p, q in zip(x, y, strict=True)])

    return score(a, b)
