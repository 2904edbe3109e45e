"""Numpy and column helpers for operators that compare the members of buckets.

A bucket is compared in tiles: its members are dealt into blocks by a hash, and every pair
of blocks is one tile, so no task holds a whole bucket. A tile reports how many links each
member has in it and a spanning forest of its links; never the pairs themselves.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def forest(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (vertex, smallest vertex of its component) of links over 0..n-1."""
    low = np.arange(n)
    while len(left):
        new = low.copy()
        np.minimum.at(new, left, low[right])
        np.minimum.at(new, right, low[left])
        new = new[new]
        if np.array_equal(new, low):
            break
        low = new
    child = np.flatnonzero(low != np.arange(n))
    return child, low[child]


def tiles(blocks: Column, block: Column) -> Column:
    """All tiles (first, second) with first <= second that a block of the bucket takes part in."""
    return F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(
            F.least(other, block).alias("first"), F.greatest(other, block).alias("second")
        ),
    )
