"""Fill-in-the-middle rows, cut and put together by Arrow compute kernels.

A text is a list of units: runs of ASCII letters, and every other code point by itself. Two
draws from a hash of the row's key cut the list into prefix, middle and suffix; two more
decide between plain text, prefix-suffix-middle (psm) and suffix-prefix-middle (spm). A batch
of texts becomes one list array whose units are views of the texts' own bytes. The flattened
units get their ordinal in the parent, are filtered by the part they belong to, and each
part's lists are rebuilt and joined. No Python code runs for a single text or unit.

One scan, no shuffle; the draws depend on the row alone, so a retried task repeats them.
Batches are worked off in pieces of about CHUNK bytes; a longer text is a piece of its own
and takes some 20 bytes of memory for each of its bytes.

Defined results: a null text counts as empty; an empty text, or one that holds a marker, is
plain. A null key draws as an empty one. Rows that repeat a key and a text give the same
output. An empty table gives an empty table. Other columns pass through; columns of the
result's names are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelyard.llm.features import portions
from modelyard.llm.text import free_name

MARKERS = ("<P>", "<S>", "<M>")  # of prefix, suffix, middle
CHUNK = 1_000_000  # bytes of text handled at once
ADDED = ("n_units", "form", "fim_text", "prefix_chars", "middle_chars")


def draws(key: Column, salt: int = 1, n: int = 4) -> Column:
    """The first n unsigned 32-bit numbers of the sha256 of `salt:key`."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda k: F.conv(F.substring(digest, k * 8 + 1, F.lit(8)), 16, 10).cast("bigint"),
    )


def units(text: pa.StringArray) -> pa.ListArray:
    """Every text as the list of its units; they share the bytes of text, which has no nulls."""
    _, offsets, data = text.buffers()
    ends = np.frombuffer(offsets, np.int32)[text.offset : text.offset + len(text) + 1]
    low = ends[0]
    raw = np.frombuffer(data, np.uint8)[low : ends[-1]] if data is not None else np.empty(0, np.uint8)
    letter = ((raw | 32) - np.uint8(97)) < 26
    begins = (raw & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    starts = ends[:-1] - low
    begins[starts[starts < len(raw)]] = True
    first = np.flatnonzero(begins).astype(np.int32)
    bounds = pa.py_buffer(np.append(first + low, ends[-1]).astype(np.int32))
    flat = pa.StringArray.from_buffers(len(first), bounds, data if data is not None else pa.py_buffer(b""))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(first, ends - low).astype(np.int32)), flat)


def _remainder(x: pa.Array, by) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, by), by))


def _joined(flat: pa.Array, lengths: pa.Array) -> pa.Array:
    """Strings made of that many units each."""
    offsets = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), flat), "")


def cut(text: pa.StringArray, h1: pa.Array, h2: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """Number of units, and prefix, middle and suffix of every text."""
    lists = units(text)
    n = pc.list_value_length(lists).cast(pa.int64())
    cuts = [_remainder(h, pc.add(n, 1)) for h in (h1, h2)]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    begin = pa.array(lists.offsets.to_numpy()[:-1].astype(np.int64))
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(begin, parent))
    in_prefix = pc.less(ordinal, pc.take(low, parent))
    in_suffix = pc.greater_equal(ordinal, pc.take(high, parent))
    in_middle = pc.invert(pc.or_(in_prefix, in_suffix))
    lengths = (low, pc.subtract(high, low), pc.subtract(n, high))
    return n, [_joined(pc.filter(flat, m), k) for m, k in zip((in_prefix, in_middle, in_suffix), lengths)]


def _transformed(batches, text: str, drawn: str, schema: pa.Schema, rate: int, spm: int, markers, size: int):
    p, s, m = markers
    for batch in batches:
        for piece in portions(batch, text, size):
            whole = pc.fill_null(piece.column(text).cast(pa.string()), "")
            h = piece.column(drawn)
            h1, h2, h3, h4 = (pc.list_element(h, k) for k in range(4))
            n, (prefix, middle, suffix) = cut(whole, h1, h2)
            plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_remainder(h3, 100), rate))
            for marker in markers:
                plain = pc.or_(plain, pc.match_substring(whole, marker))
            swapped = pc.less(_remainder(h4, 100), spm)
            out = pc.if_else(
                plain,
                whole,
                pc.if_else(
                    swapped,
                    pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, ""),
                    pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, ""),
                ),
            )
            form = pc.if_else(plain, "plain", pc.if_else(swapped, "spm", "psm"))
            nothing = pa.scalar(None, pa.int64())
            chars = [pc.if_else(plain, nothing, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
            made = dict(zip(ADDED, (n, form, out, *chars)))
            columns = [made[f.name] if f.name in made else piece.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)


def transform(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rate: int = 90,
    spm: int = 20,
    salt: int = 1,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """docs with n_units, form, fim_text, prefix_chars and middle_chars.

    rate: percent of the texts that are cut; spm: percent of those that start with the suffix.
    prefix_chars and middle_chars count code points and are null for plain rows.
    """
    drawn = free_name(docs, "draws")
    rest = [f for f in docs.schema.fields if f.name.lower() not in ADDED]
    kinds = (T.LongType(), T.StringType(), T.StringType(), T.LongType(), T.LongType())
    schema = T.StructType([*rest, *[T.StructField(x, kind) for x, kind in zip(ADDED, kinds)]])
    size = CHUNK
    names = pa.schema([(f.name, pa.null()) for f in schema.fields])
    return (
        docs.select(*[F.col(f"`{f.name}`") for f in rest], draws(F.col(f"`{key}`"), salt).alias(drawn))
        .mapInArrow(lambda batches: _transformed(batches, text, drawn, names, rate, spm, markers, size), schema)
    )


def restored(fim_text: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The exact text, rebuilt from the output and its form."""
    p, s, m = map(re.escape, markers)
    psm = F.regexp_replace(fim_text, f"(?s)^{p}(.*?){s}(.*?){m}(.*)$", "$1$3$2")
    spm = F.regexp_replace(fim_text, f"(?s)^{s}(.*?){p}(.*?){m}(.*)$", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(fim_text)
