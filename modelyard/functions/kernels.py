"""Element arithmetic on one chunk of weights, as numpy over Arrow batches.

Spark's array lambdas cost microseconds per element; these cost nanoseconds. Each
kernel sees the arrays of one chunk row and nothing else: which chunks meet is
decided by joins, and figures per tensor come from aggregations. A model that does
not match is ``None``. Sums run in float64, results are float32.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, pandas_udf

FLOATS = T.ArrayType(T.FloatType())


def _cells(column: pa.Array) -> list:
    """Row values; lists as views into the batch, without a copy."""
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    known = column.is_valid().to_pylist()
    return [flat[ends[i] : ends[i + 1]] if ok else None for i, ok in enumerate(known)]


def _lists(arrays: list, dtype) -> pa.Array:
    sizes = [0 if a is None else len(a) for a in arrays]
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.concatenate([np.empty(0, dtype), *[a for a in arrays if a is not None]])
    missing = pa.array([a is None for a in arrays], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(dtype)), mask=missing)


def per_chunk(kernel: Callable):
    """Column function that runs ``kernel`` on every row; None gives null."""

    def run(*columns: pa.Array) -> pa.Array:
        rows = zip(*[_cells(c) for c in columns])
        return _lists([kernel(*row) for row in rows], np.float32)

    return arrow_udf(run, FLOATS)


def per_chunk_sums(kernel: Callable):
    """Like ``per_chunk`` for kernels that return a few sums in float64."""

    def run(*columns: pa.Array) -> pa.Array:
        sums = [kernel(*row) for row in zip(*[_cells(c) for c in columns])]
        return pa.array(sums, pa.list_(pa.float64()))

    return arrow_udf(run, T.ArrayType(T.DoubleType()))


def per_chunk_counts(kernel: Callable, key: str):
    """Like ``per_chunk`` for kernels that return a pair (keys, counts)."""

    def run(*columns: pa.Array) -> pa.Array:
        pairs = [kernel(*row) for row in zip(*[_cells(c) for c in columns])]
        keys = _lists([p[0] for p in pairs], np.int32)
        counts = _lists([p[1] for p in pairs], np.int64)
        return pa.StructArray.from_arrays([keys, counts], names=[key, "n"])

    fields = [T.StructField(key, T.ArrayType(T.IntegerType())), T.StructField("n", T.ArrayType(T.LongType()))]
    return arrow_udf(run, T.StructType(fields))


def difference(base, values):
    return None if values is None else values - base


def round_bfloat16(values):
    """Keep the upper half of each float's bits, rounding to nearest, ties to even."""
    bits = np.array(values, dtype=np.float32).view(np.uint32)
    up = np.uint32(0x7FFF) + ((bits >> np.uint32(16)) & np.uint32(1))
    with np.errstate(over="ignore"):
        rounded = ((bits + up) & np.uint32(0xFFFF0000)).view(np.float32)
    return np.where(np.isnan(values), np.float32(np.nan), rounded).astype(np.float32)


def dot_products(base, values):
    """Sums of x*x, y*y and x*y; none without a matching chunk."""
    if values is None:
        return None
    x, y = base.astype(np.float64), values.astype(np.float64)
    return [float(x @ x), float(y @ y), float(x @ y)]


def mix(base, values, w0, w1):
    if values is None:
        return base
    return (w0 * base.astype(np.float64) + w1 * values.astype(np.float64)).astype(np.float32)


def weighted_move(scaling: float, weights: list[float]) -> Callable:
    """Base plus the scaled, weighted sum of deltas."""

    def kernel(base, *models):
        moved = np.zeros(len(base), dtype=np.float64)
        for w, values in zip(weights, models):
            if values is not None:
                moved += w * (values - base).astype(np.float64)
        return (base + scaling * moved).astype(np.float32)

    return kernel


# --- magnitudes --------------------------------------------------------------


def _magnitude_bits(base, values):
    """Bit patterns of |delta|; for non-negative floats they sort like the values."""
    return np.abs(values - base).astype(np.float32).view(np.uint32)


def magnitude_summary(points: int) -> Callable:
    """Every step-th magnitude, falling, with the number of elements it stands for.

    The sum of numbers down to a point undercounts the elements that are at least as large by
    less than a step.
    """

    def kernel(base, values):
        if values is None:
            return None, None
        bits = np.sort(_magnitude_bits(base, values).view(np.int32))[::-1]
        ranks = np.arange(0, len(bits), max(1, -(-len(bits) // points)))[1:]
        ranks = np.append(ranks, len(bits))[: len(bits)]
        return bits[ranks - 1], np.diff(ranks, prepend=0)

    return kernel


def magnitudes_between(base, values, low, high):
    """Counts of the magnitudes; those outside (low, high) count at the nearer end.

    A tensor without elements has no ends.
    """
    if values is None or low is None:
        return None, None
    bits = _magnitude_bits(base, values).view(np.int32)
    over, inside = np.count_nonzero(bits >= high), bits[(bits > low) & (bits < high)]
    found, counts = np.unique(inside, return_counts=True)
    return np.append(found, [low, high]), np.append(counts, [len(bits) - len(inside) - over, over])


@pandas_udf(T.FloatType())
def value_of_bits(bits: pd.Series) -> pd.Series:
    """The magnitude with these bits."""
    return pd.Series(bits.to_numpy().astype(np.int32).view(np.float32))


def cut_below(base, values, limit):
    """Delta with everything strictly below ``limit`` set to zero; ties stay.

    A tensor without elements has no limit.
    """
    if values is None:
        return None
    delta = values - base
    if limit is None:
        return delta
    return np.where(np.abs(delta) < np.float32(limit), np.float32(0), delta)


# --- votes -------------------------------------------------------------------


def elect(n: int, deltas) -> np.ndarray:
    """Sign of the vote count per element; a tie elects plus."""
    votes = np.zeros(n)
    for d in deltas:
        if d is not None:
            votes += np.sign(d)
    return np.where(votes < 0, -1.0, 1.0)


def elected_signs(base, *deltas):
    return elect(len(base), deltas).astype(np.float32)


def _merge_agreeing(base, deltas, weights, scaling):
    """Move by the mean of the deltas that carry the elected sign."""
    sign = elect(len(base), deltas)
    total, mass = np.zeros(len(base)), np.zeros(len(base))
    for w, d in zip(weights, deltas):
        if d is not None:
            agrees = np.sign(d) == sign
            total += np.where(agrees, w * d.astype(np.float64), 0.0)
            mass += np.where(agrees, w, 0.0)
    mean = np.divide(total, mass, out=np.zeros(len(base)), where=mass > 0)
    return (base + scaling * mean).astype(np.float32)


def trimmed_vote(scaling: float, weights: list[float]) -> Callable:
    """Arguments: base, then every model's values, then every model's limit."""

    def kernel(base, *rest):
        n = len(weights)
        deltas = [cut_below(base, v, t) for v, t in zip(rest[:n], rest[n:])]
        return _merge_agreeing(base, deltas, weights, scaling)

    return kernel


def _draws(head: int, start: int, n: int) -> np.ndarray:
    """A 32-bit draw per element from a per-tensor number: equal on every retry."""
    width = np.int64(2**32)
    idx = np.int64(start) + np.arange(n, dtype=np.int64)
    x = (np.int64(head) + (idx % 2**31) * np.int64(2654435761) + (idx >> 31)) % width
    for _ in range(2):
        x = ((x ^ (x >> 16)) * np.int64(73244475)) % width
    return x ^ (x >> 16)


def thin(base, values, head, start, density):
    """Drop elements with probability 1 - density and scale the rest by 1 / density."""
    if values is None:
        return None
    keep = _draws(head, start, len(base)) < int(density * 2**32)
    scaled = ((values - base).astype(np.float64) / density).astype(np.float32)
    return np.where(keep, scaled, np.float32(0))


def thinned_vote(scaling: float, weights: list[float], density: float) -> Callable:
    """Arguments: start, base, then every model's values, then every model's head."""

    def kernel(start, base, *rest):
        n = len(weights)
        deltas = [thin(base, v, h, start, density) for v, h in zip(rest[:n], rest[n:])]
        return _merge_agreeing(base, deltas, weights, scaling)

    return kernel


def consensus(epsilon: float) -> Callable:
    """Mean delta where every matching model has the same sign (zero is a sign)."""

    def kernel(base, *models):
        deltas = [v - base for v in models if v is not None]
        if not deltas:
            return base
        signs = [np.sign(d) for d in deltas]
        agree = np.logical_and.reduce([s == signs[0] for s in signs])
        mean = sum(d.astype(np.float64) for d in deltas) / len(deltas)
        return (base + np.where(agree & (np.abs(mean) >= epsilon), mean, 0.0)).astype(np.float32)

    return kernel


ROWS_AT_ONCE = 512


def fold_blocks(scale: float, rank: int) -> Callable:
    """Stream of blocks: the runs of side A (kind 0), then per row its factors (1) and its part
    of the weights (2), which are moved by scale * factors * runs."""

    def moved(rows: list, runs: dict, width: int) -> list:
        """The weights of rows (values, factors) of one block."""
        known = [k for k, (_, f) in enumerate(rows) if f is not None]
        out = [v for v, _ in rows]
        if known and runs:
            side_a = np.zeros((rank, width))
            for r, run in runs.items():
                if r < rank:
                    side_a[r] = run
            product = scale * (np.stack([rows[k][1] for k in known]).astype(np.float64) @ side_a)
            for k, change in zip(known, product):
                out[k] = (out[k].astype(np.float64) + change).astype(np.float32)
        return out

    def run(batches):
        block, runs, factors = None, {}, (None, None)
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in ("tensor", "chunk", "grp"))))
            kinds, rows = batch.column("kind").to_pylist(), batch.column("row").to_pylist()
            values, small = _cells(batch.column("values")), _cells(batch.column("factors"))
            taken, results, waiting = [], [], []
            for at, (key, kind, row, cell, part) in enumerate(zip(keys, kinds, rows, values, small)):
                if key != block or len(waiting) >= ROWS_AT_ONCE:
                    results += moved(waiting, runs, len(waiting[0][0]) if waiting else 0)
                    waiting = []
                if key != block:
                    block, runs, factors = key, {}, (None, None)
                if kind == 0:
                    runs[row] = np.array(part)
                elif kind == 1:
                    factors = row, np.array(part)
                elif cell is None:
                    taken.append(at)
                    results += moved(waiting, runs, len(waiting[0][0]) if waiting else 0) + [None]
                    waiting = []
                else:
                    taken.append(at)
                    waiting.append((cell, factors[1] if factors[0] == row else None))
            results += moved(waiting, runs, len(waiting[0][0]) if waiting else 0)
            kept = batch.take(pa.array(taken, pa.int32()))
            columns = [kept.column(k) for k in ("tensor", "row", "chunk", "start")]
            yield pa.RecordBatch.from_arrays(
                [*columns, _lists(results, np.float32)], names=["tensor", "row", "chunk", "start", "values"]
            )

    return run
