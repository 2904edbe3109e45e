"""Exact encoding and decoding with a merge-type (BPE) piece vocabulary.

Encoding by backtracking: an Aho-Corasick automaton gives the longest piece at every place;
a piece may follow another only if re-merging the two together gives them back; on a dead
end the last piece is shortened, and a bitfield of failed places keeps the walk linear.
Because valid sequences are unique, this equals merging from the characters up.

Texts are cut where no piece of the vocabulary spans the cut, so each stretch (mostly a
word) is encoded alone; a task remembers a bounded number of stretches and of pairs.

Defined results: a null text counts as empty and gives the end id only; characters without
a piece become byte pieces. Equal texts and repeated rows get equal ids, an empty table an
empty table; extra columns pass through and columns of the result's names are replaced.
The vocabulary is a parameter (a model file's content, about half a megabyte) and is never
part of this package.
"""

from __future__ import annotations

import codecs
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.llm.text import free_name

MARK = "▁"
KNOWN_STRETCHES = 100_000
KNOWN_PAIRS = 300_000
CHUNK = 1_000_000  # bytes of text encoded at once
NORMAL, USER_DEFINED = 1, 4


class Vocabulary:
    """Pieces of a model file and what the walk needs to know of them."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        count = library.get_piece_size()
        pieces = [library.id_to_piece(i) for i in range(count)]
        special = [
            library.is_control(i) or library.is_byte(i) or library.is_unknown(i) or library.is_unused(i)
            for i in range(count)
        ]
        self.id_of = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.score = [library.get_score(i) for i in range(count)]
        self.pieces = pieces
        self.end = library.eos_id()
        self.unknown = library.unk_id()
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(pieces) if library.is_byte(i)}
        # a piece that merging does not rebuild can never be part of an encoding
        own = {p for p in self.id_of if self._rebuilt(p)}
        self.usable = {p: self.id_of[p] for p in own}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.usable.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.length = [len(p) for p in pieces]
        self.shorter = {i: self._longest_prefix(p) for p, i in self.usable.items()}
        self.joints = {a + b for p in self.id_of for a, b in zip(p, p[1:])}
        self.plain = self._texts(special)
        self.fits = Remembered(lambda pair: self.fit_together(*pair), KNOWN_PAIRS)
        single = "".join(re.escape(p) for p in self.usable if len(p) == 1)
        self.foreign = re.compile(f"[^{single}]")

    def merged(self, text: str) -> list[str]:
        """Merge the best adjacent pair, leftmost first, until none is left."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < len(parts):
                both = parts[i] + parts[j]
                if both in self.id_of:
                    heapq.heappush(heap, (-self.score[self.id_of[both]], i, both))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def _rebuilt(self, piece: str) -> bool:
        return self.merged(piece) == [piece]

    def _longest_prefix(self, piece: str) -> int:
        for n in range(len(piece) - 1, 0, -1):
            if piece[:n] in self.usable:
                return self.usable[piece[:n]]
        return -1

    def _texts(self, special: list[bool]) -> list[str]:
        """What each id decodes to; bytes that are not ASCII as lone surrogates."""
        out = []
        for i, p in enumerate(self.pieces):
            out.append("" if special[i] else p.replace(MARK, " "))
        for value, i in self.byte_id.items():
            out[i] = chr(value) if value < 128 else chr(0xDC00 + value)
        if self.unknown >= 0:
            out[self.unknown] = " ⁇ "
        return out

    def fit_together(self, left: int, right: int) -> bool:
        """Re-merging the two pieces' characters gives the two pieces back."""
        a, b = self.pieces[left], self.pieces[right]
        return self.merged(a + b) == [a, b]

    def encode_stretch(self, text: str) -> list[int]:
        """Ids of any stretch: the walk, cut around characters without a piece."""
        # the longest pieces from left to right are where the walk begins; mostly they do
        out = [x[1] for _, x in self.automaton.iter_long(text)]
        length, fits = self.length, self.fits
        if sum([length[i] for i in out]) != len(text):
            return self._around_foreign(text)
        for pair in zip(out, out[1:]):
            if not fits[pair]:
                return self._backtrack(text, out)
        return out

    def _backtrack(self, text: str, greedy: list[int]) -> list[int]:
        n, at = len(text), 0
        length, shorter, fits, automaton = self.length, self.shorter, self.fits, self.automaton
        longest = {}
        for piece in greedy:
            longest[at] = piece
            at += length[piece]
        failed = 0  # a bit for every place from which no valid rest was found
        out: list[int] = []
        at, piece, before = 0, greedy[0], -1
        while True:
            while piece >= 0:
                end = at + length[piece]
                if not failed >> end & 1 and (before < 0 or fits[before, piece]):
                    break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                if end == n:
                    return out
                at, before = end, piece
                if at in longest:
                    piece = longest[at]
                else:
                    piece = longest[at] = next(automaton.iter_long(text, at))[1][1]
            else:
                if not out:
                    raise ValueError("the vocabulary is not of the merge type")
                failed |= 1 << at
                piece = out.pop()
                at -= length[piece]
                before = out[-1] if out else -1
                piece = shorter[piece]

    def _around_foreign(self, text: str) -> list[int]:
        out: list[int] = []
        at = 0
        for m in self.foreign.finditer(text):
            if m.start() > at:
                out += self.encode_stretch(text[at : m.start()])
            if self.byte_id:
                out += [self.byte_id[b] for b in m.group().encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
            at = m.end()
        return out + self.encode_stretch(text[at:]) if at < len(text) else out


class Remembered(dict):
    """Results of a function for the arguments of late: two generations of bounded size."""

    def __init__(self, compute, size: int):
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


_TAIL = ".,;:!?"


class Codec:
    """Encoder and decoder of one task; ids travel as arrays."""

    def __init__(self, model: bytes):
        v = self.vocabulary = Vocabulary(model)
        # a mark never follows another character inside a piece, or words could not be cut
        self.cut = all(MARK not in p.lstrip(MARK) for p in v.id_of)
        joined = {c for pair in v.joints for c in pair}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined)
        self.lines_apart = "\n" not in joined
        self.words = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+|[{alone}]")
        self.known = Remembered(self._stretch, KNOWN_STRETCHES)
        raw = [p.encode("utf-8", "surrogateescape") for p in v.plain]
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.piece_size = np.array([len(p) for p in raw], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.marked = np.array([p.startswith(MARK) for p in v.pieces])

    def _stretch(self, text: str) -> bytes:
        v = self.vocabulary
        word = text.rstrip(_TAIL)
        if word and len(word) < len(text) and text[len(word) - 1 : len(word) + 1] not in v.joints:
            return self.known[word] + self.known[text[len(word) :]]
        return array("i", v.encode_stretch(text)).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of one text, the end id last."""
        v = self.vocabulary
        if not text:
            return np.array([v.end], np.int32)
        marked = MARK + text.replace(" ", MARK)
        stretches = self.words.findall(marked) if self.cut else [marked]
        raw = b"".join(map(self.known.__getitem__, stretches))
        return np.append(np.frombuffer(raw, np.int32), np.int32(v.end))

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of many texts. Each distinct stretch is looked up once.

        Texts with runs of spaces, marks of their own or nothing in them take the plain way.
        """
        texts = pc.fill_null(texts, "")
        plain = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, MARK))
        plain = pc.or_(plain, pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, "\x01")))
        plain = pc.or_(plain, pc.equal(pc.binary_length(texts), 0)).to_numpy(zero_copy_only=False)
        if not (self.cut and self.lines_apart):
            plain[:] = True
        rows: list = [None] * len(texts)
        for i in np.flatnonzero(plain):
            rows[i] = self.encode(texts[i].as_py())
        easy = np.flatnonzero(~plain)
        if len(easy):
            t = pc.binary_join_element_wise(MARK, texts.take(pa.array(easy)), "")
            t = pc.replace_substring(pc.replace_substring(t, " ", f"\x01{MARK}"), "\n", "\x01\n\x01")
            split = pc.split_pattern(t, "\x01")
            coded = split.flatten().dictionary_encode()
            found = [self.known[w] if w else b"" for w in coded.dictionary.to_pylist()]
            flat = np.frombuffer(b"".join(found), np.int32)
            size = np.array([len(x) >> 2 for x in found], np.int64)
            codes = coded.indices.to_numpy()
            ids, ends = _gathered(flat, np.cumsum(size) - size, size, codes)
            edge = split.offsets.to_numpy() - split.offsets[0].as_py()
            ends = np.concatenate([[0], ends])[edge]
            for i, begin, end in zip(easy, ends[:-1], ends[1:]):
                rows[i] = np.append(ids[begin:end], np.int32(self.vocabulary.end))
        offsets = np.cumsum([0, *map(len, rows)])
        return (np.concatenate(rows) if rows else np.empty(0, np.int32)), offsets

    def decode_batch(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of many rows of ids: pieces in a row, without the first one's mark.

        Control ids are empty; bytes that are not UTF-8 become one replacement character each.
        """
        start, size = self.piece_start[ids], self.piece_size[ids]
        before = np.concatenate([[0], np.cumsum(size)])
        for begin, end in zip(offsets[:-1], offsets[1:]):
            first = begin
            while first < end and not size[first]:
                first += 1
            if first < end and self.marked[ids[first]]:
                start[first] += 1
                size[first] -= 1
        raw, ends = _gathered(self.piece_bytes, start, size, None)
        edge = np.concatenate([[0], ends])[offsets]
        out = pa.StringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(edge.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())
        )
        try:
            out.validate(full=True)
            return out
        except pa.ArrowInvalid:
            data = raw.tobytes()
            return pa.array(
                [data[a:b].decode("utf-8", "one_by_one") for a, b in zip(edge[:-1], edge[1:])], pa.string()
            )

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int32)
        return self.decode_batch(ids, np.array([0, len(ids)]))[0].as_py()


def _gathered(values, start, size, codes):
    """Stretches of values, start[c] to start[c] + size[c] for each code; and where each ends."""
    if codes is not None:
        start, size = start[codes], size[codes]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(start - (ends - size), size)
    return values[at], ends


codecs.register_error("one_by_one", lambda e: ("\ufffd", e.start + 1))


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    return Codec(model)


def _portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of rows with about CHUNK bytes of text."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(total):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + CHUNK, side="right")))
        yield begin, end
        begin = end


def _encoded(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            for begin, end in _portions(batch.column(batch.num_columns - 1)):
                part = batch.slice(begin, end - begin)
                ids, offsets = c.encode_batch(part.column(part.num_columns - 1))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], lists, c.decode_batch(ids, offsets)],
                    names=[*part.schema.names[:-1], "ids", "decoded"],
                )

    return run


def model_bytes(path: str) -> bytes:
    """The vocabulary file, read once on the driver and sent with the tasks."""
    return Path(path).read_bytes()


def encode(
    docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """docs without the text, with its ids (end id last) and the text decoded from them."""
    from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

    taken = {ids.lower(), decoded.lower(), text.lower()}
    rest = [c for c in docs.columns if c.lower() not in taken]
    spare = free_name(docs, "text_to_encode")
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(text).cast("string").alias(spare))
    schema = StructType(
        [docs.schema[c] for c in rest]
        + [StructField(ids, ArrayType(IntegerType())), StructField(decoded, StringType())]
    )
    return rows.mapInArrow(_encoded(model), schema)
