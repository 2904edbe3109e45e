"""Text expressions: tokens, stems, patterns, common subsequences."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from modelyard import constants as K
from modelyard.functions.stemming import porter


def tokens(text: Column) -> Column:
    """Lowercased runs of ``[a-z0-9]``."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, "[^a-z0-9]+"), "")


def _stem(token: str) -> str:
    return porter(token) if len(token) > 3 else token


def _encoded(lists: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All tokens of a batch as codes, and where each row's tokens end."""
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    return lists.flatten().dictionary_encode(), np.concatenate([[0], np.cumsum(sizes)])


@arrow_udf(T.ArrayType(T.StringType()))
def stems(lists: pa.Array) -> pa.Array:
    """Porter stems of tokens longer than three; once per distinct word of a batch."""
    coded, ends = _encoded(lists)
    stemmed = pa.array([_stem(t) for t in coded.dictionary.to_pylist()], pa.string())
    return pa.ListArray.from_arrays(
        pa.array(ends.astype(np.int32)), stemmed.take(coded.indices), mask=lists.is_null()
    )


def shared_items(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Long lists without what only one of them has, in order; it adds to no match."""
    if len(a) > 64 or len(b) > 64:
        a = a[np.isin(a, b)]
        b = b[np.isin(b, a)]
    return a, b


LCS_BITS = 8192  # tokens of one side handled at once


def common_subsequence(a, b, bits: int = LCS_BITS) -> int:
    """Length of the longest common subsequence by bit rows (Hyyro, 2004).

    a and b are code arrays. Tokens of one side only are dropped first. The shorter side is
    cut into blocks of ``bits``; a block goes over the whole other side and hands a carry bit
    per token to the next one. A block has at most ``bits`` masks of ``bits`` bits (8 MB) and
    a carry takes a byte a token, so memory is linear whatever the lengths.
    """
    a, b = shared_items(np.asarray(a), np.asarray(b))
    return _subsequence(a.tolist(), b.tolist(), bits)


def _subsequence(a: list, b: list, bits: int = LCS_BITS) -> int:
    if len(a) > len(b):
        a, b = b, a
    length, others = 0, b
    carry = None
    for begin in range(0, len(a), bits):
        block = a[begin : begin + bits]
        where: dict = {}
        for i, t in enumerate(block):
            where[t] = where.get(t, 0) | (1 << i)
        full, last = (1 << len(block)) - 1, begin + bits >= len(a)
        row, out = full, None if last else bytearray(len(others))
        for k, t in enumerate(others):
            mask = where.get(t, 0)
            over = carry[k] if carry else 0
            if mask or over:
                # matched places lose their bit, which moves up to the next one that is free
                hit = row & mask
                total = row + hit + over
                if out is not None and total > full:
                    out[k] = 1
                row = (total | (row & ~mask)) & full
        length += len(block) - row.bit_count()
        carry = out
    return length


def clipped_matches(a, b) -> int:
    """Items common to both lists, each as often as the rarer side has it."""
    left: dict = {}
    for t in a:
        left[t] = left.get(t, 0) + 1
    found = 0
    for t in b:
        n = left.get(t, 0)
        if n:
            left[t] = n - 1
            found += 1
    return found


#: Any byte that is no letter or digit of a token ends one; other scripts have none below 128.
_BREAKS = bytes(c if chr(c) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for c in range(256))
STEMS_KEPT = 200_000  # words a worker remembers, some 40 MB


class _Stems(dict):
    """Stems of the words met so far; forgets them all when there are too many."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= STEMS_KEPT:
            self.clear()
        self[word] = found = _stem(word.decode()).encode()
        return found


def _pairs(tokens: list) -> Iterator[tuple]:
    return zip(tokens, tokens[1:])


def _shared(a: list, b: list, items: Callable[[list], Iterable] = iter) -> tuple[list, list]:
    """Items of both lists without those that only one of them has, in order."""
    if len(a) > len(b):
        return _shared(b, a, items)[::-1]
    b = list(filter(set(items(a)).__contains__, items(b)))
    return list(filter(set(b).__contains__, items(a))), b


#: A word of as many letters keeps its first two in its stem (shorter: "dying", "aings").
KEEPS_START = 6


def _stemmed(a: list, b: list, stems: _Stems) -> tuple[list, list]:
    """Stems of both lists; None for words of the longer one that begin like none of the other."""
    if len(a) > len(b):
        return _stemmed(b, a, stems)[::-1]
    a = [stems[w] for w in a]
    starts = {s[:2] for s in a}
    return a, [stems[w] if len(w) < KEEPS_START or w[:2] in starts else None for w in b]


def overlap(stem: bool):
    """Column function of two lowered texts: their numbers of tokens (p and r), matches of single
    tokens (m1), of adjacent pairs (m2) and the common subsequence (lcs).

    Both texts sit in one row, so nothing is shuffled. Texts are cut in the worker, one row at a
    time, so it holds the tokens of one row however many rows a batch has. A word is stemmed
    once while it is remembered.
    """

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        stems = _Stems()
        counts = []
        for texts in zip(left.cast(pa.binary()), right.cast(pa.binary())):
            a, b = [(t.as_py() or b"").translate(_BREAKS).split() for t in texts]
            if stem:
                a, b = _stemmed(a, b, stems)
            one, two = _shared(a, b), _shared(a, b, _pairs)
            counts.append((len(a), len(b), clipped_matches(*one), clipped_matches(*two), _subsequence(*one)))
        columns = list(zip(*counts)) if counts else [[]] * len(_COUNTS)
        return pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in columns], names=_COUNTS)

    return arrow_udf(run, T.StructType([T.StructField(n, T.IntegerType()) for n in _COUNTS]))


_COUNTS = ["p", "r", "m1", "m2", "lcs"]


def f_measure(overlap: Column, n_prediction: Column, n_reference: Column) -> Column:
    """Harmonic mean of precision and recall: 2m / (p + r), 0 without overlap."""
    return F.coalesce(
        F.try_divide(2.0 * overlap, (n_prediction + n_reference).cast("double")), F.lit(0.0)
    )


def hallucination_words(prediction: Column) -> Column:
    """Overconfident wording. Flags: ignore case, only \\n ends a line, Unicode classes."""
    hits = [prediction.rlike("(?idU)" + p) for p in K.HALLUCINATION_PATTERNS]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def fill(template: str, **columns: Column) -> Column:
    """Template with ``{name}`` slots as one concat; other braces stay literal."""
    parts = []
    for piece in re.split(r"(\{[A-Za-z0-9_]+\})", template):
        slot = piece[1:-1] if piece.startswith("{") and piece.endswith("}") else None
        if slot in columns:
            parts.append(F.coalesce(columns[slot].cast("string"), F.lit("")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
