"""Hashed text features in numpy, for batches of whole texts inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1_000_000  # characters handled at once; a longer text is a chunk of its own
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def chunks(column: pa.Array) -> Iterator[list[str]]:
    """Lists of texts with about CHUNK characters together; null counts as empty."""
    part, total = [], 0
    for value in column:
        text = value.as_py() or ""
        if part and total + len(text) > CHUNK:
            yield part
            part, total = [], 0
        part.append(text)
        total += len(text)
    if part:
        yield part


def portions(batch: pa.RecordBatch, text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about that many bytes of text; a longer text is one of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for row, n in enumerate(sizes):
        if total and total + n > size:
            yield batch.slice(begin, row - begin)
            begin, total = row, 0
        total += n
    if batch.num_rows:
        yield batch.slice(begin)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the offsets of the texts."""
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).astype(np.uint64), np.cumsum([0, *map(len, texts)])


def mixed(h: np.ndarray, bits: int) -> np.ndarray:
    """The high bits of a multiplied hash."""
    h = (h ^ (h >> np.uint64(32))) * _ODD
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def ngram_bins(codes: np.ndarray, offsets: np.ndarray, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of every character n-gram and the offsets of the texts; none spans two texts."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = (h + codes[k : k + n]) * _STEP
    keep = np.ones(n, bool)
    for k in range(1, size):
        ends = offsets[1:-1] - k
        keep[ends[(ends >= 0) & (ends < n)]] = False
    bins = mixed(h, bits)
    before = np.concatenate([[0], np.cumsum(keep)])
    return bins[keep], before[np.minimum(offsets, n)]


_SPACE, _WORD, _OTHER = 0, 1, 2


def _classes() -> np.ndarray:
    table = np.full(0x3000, _OTHER, np.uint8)
    for c in range(len(table)):
        if chr(c).isalnum():
            table[c] = _WORD
        elif chr(c).isspace():
            table[c] = _SPACE
    return table


_CLASS = _classes()


def token_bins(codes: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of every token, and the offsets of the texts.

    A token is a run of letters and digits or a run of other visible characters.
    """
    n = len(codes)
    if n == 0:
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = np.where(codes < len(_CLASS), _CLASS[np.minimum(codes, len(_CLASS) - 1).astype(np.int64)], _WORD)
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    first[offsets[:-1][offsets[:-1] < n]] = True
    begin = np.flatnonzero(first)
    spaced = kind[begin] == _SPACE
    # a token's hash: the sum of its scrambled code points, weighted by their place
    place = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    weight = (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _STEP
    scrambled = (codes + np.uint64(1)) * _ODD
    scrambled ^= scrambled >> np.uint64(29)
    total = np.add.reduceat(scrambled * weight, begin)
    bins = mixed(total[~spaced], bits)
    return bins, np.searchsorted(begin[~spaced], offsets)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """crc32 of the id as text falls on the given remainder. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(True))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int
) -> DataFrame:
    """(text, label, weight) of at most per_class documents of each label 0 and 1.

    Rows are taken in the order of a hash of their id; weight makes up for the share of a
    class that was taken. usable, over doc_id, says which labels may be learned from.
    The sample's ids are bounded, so they are sent to the documents.
    """
    known = labels.filter(F.col(label).isin(0, 1) & usable).select("doc_id", F.col(label).cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = None
    for value, size in sorted(sizes.items()):
        part = (
            known.filter(F.col("label") == value)
            .orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id")
            .limit(per_class)
            .withColumn("weight", F.lit(max(1.0, size / per_class)))
        )
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        parts = known.withColumn("weight", F.lit(1.0))
    return docs.select("doc_id", "text").join(F.broadcast(parts), "doc_id").select("text", "label", "weight")
