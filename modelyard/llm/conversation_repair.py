"""Cheapest repair of a conversation's structure, by dynamic programming over a grammar.

A conversation's turns, in order, become a string of symbols: the class of the role (system,
user, assistant, other) and the first fault (blank, duplicate, truncated). Its roles shall
read s?(ua)+ or nothing; that is a machine of four states, and a turn is a min-plus matrix
over them: the least cost from a state to another, with the edits that reach it. Re-Pair
rules name frequent pairs of symbols, over all conversations, round after round; a rule's
matrix is the product of its two sides and is computed once, on the driver, bottom-up. Its
edits are a rope: the two sides and the state between them. A conversation is its string,
shortened by the rules, as a product of a vector with a few matrices, then a walk back.

Edits: Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert (an empty user or
assistant turn) 3. Blank and duplicate turns must be deleted; a truncated turn that stays
adds 3. Of the cheapest edits those whose initials come first in ASCII are taken. From one
state, edits of equal cost over the same turns are never a prefix of one another, as both end
with the edit of the last turn; so first places compare, and a rank per state decides ties.

Spread: keys of the turns (no texts) are range-partitioned by (conversation, turn), so a long
conversation lies in many partitions; its symbols are gathered in segments of at most
SEGMENT turns. Duplicates are found by one aggregation that combines in the map tasks and a
join on the turn's unique place. Texts are shuffled once, by conversation, and read as a
stream: a task holds one byte a turn for the walk back and the turn at hand. One task reads a
conversation's texts, since a digest or a numbering of its repaired turns is a sequence.

Defined results: turns are ordered by turn (nulls first), then role, then the text's md5.
Null roles and texts are one space. A conversation of null id is one like the others. A role
without a character has no class and fits nowhere. Repeated rows are duplicates. An empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelyard.llm.text import NOT_SPACE
from modelyard.session import written

RECOLOUR, DELETE, INSERT, CLOSE = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)  # states: what the last turn was
SEGMENT_BITS = 12
ROUNDS, PER_ROUND = 12, 16  # bounds of the grammar; turns beyond it cost a matrix each
REMEMBERED = 20_000  # short strings a task keeps the edits of
INFINITE = 1 << 60
ROLES = "suax"
FAULTS = ("none", "blank", "duplicate", "truncated")
_FIRST_RULE = 0x4E00
_MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_INSERTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}


def symbol(role: int, fault: int) -> str:
    return chr(65 + 4 * fault + role)


class Matrix(NamedTuple):
    """Costs from state to state, the rank of an entry's edits among those of its row, and
    the edits: strings of one turn, or for a rule the state between its two sides."""

    cost: list[list[int]]
    rank: list[list[int]]
    edits: list[list]


def _inserts() -> list[dict[int, tuple[int, str]]]:
    """Per state the cheapest inserts that lead to each state."""
    out = []
    for state in range(4):
        reached, at, cost, edits = {state: (0, "")}, state, 0, ""
        while (at := _INSERTED[at]) not in reached:
            cost, edits = cost + INSERT, edits + "I"
            reached[at] = cost, edits
        out.append(reached)
    return out


def _turn_matrix(role: str, fault: str) -> Matrix:
    """Inserts, then one edit of the turn."""
    found = [[(INFINITE, "")] * 4 for _ in range(4)]
    extra = CLOSE if fault == "truncated" else 0
    for i, inserts in enumerate(_inserts()):
        for state, (cost, edits) in inserts.items():
            options = [(state, DELETE, "D")]
            if fault in ("none", "truncated"):
                if (state, role) in _MOVES:
                    options.append((_MOVES[state, role], extra, "K"))
                options.append((_INSERTED[state], RECOLOUR + extra, "R"))
            for j, more, edit in options:
                found[i][j] = min(found[i][j], (cost + more, edits + edit))
    rank = [[sorted(e for _, e in row).index(row[j][1]) for j in range(4)] for row in found]
    return Matrix([[c for c, _ in row] for row in found], rank, [[e for _, e in row] for row in found])


def step(cost: list[int], rank: list[int], matrix: Matrix) -> tuple[list[int], list[int], list[int]]:
    """Costs, ranks and the states before, after a vector has gone through a matrix."""
    new, via = [INFINITE] * 4, [0] * 4
    for j in range(4):
        best = None
        for i in range(4):
            total = cost[i] + matrix.cost[i][j]
            if total < INFINITE and (best is None or (total, rank[i]) < best):
                best, via[j] = (total, rank[i]), i
        if best:
            new[j] = best[0]
    order = sorted(range(4), key=lambda j: (rank[via[j]], matrix.rank[via[j]][j]))
    places = [0] * 4
    for place, j in enumerate(order):
        places[j] = place
    return new, places, via


def product(left: Matrix, right: Matrix) -> Matrix:
    rows = [step(left.cost[i], left.rank[i], right) for i in range(4)]
    return Matrix(*([row[k] for row in rows] for k in range(3)))


class Grammar:
    """Rules by round: pairs of symbols and the symbol that stands for them."""

    def __init__(self, rounds: list[list[tuple[str, str]]] = ()):
        self.rounds = [list(x) for x in rounds]
        self.matrices = {
            symbol(r, f): _turn_matrix(role, fault)
            for r, role in enumerate(ROLES)
            for f, fault in enumerate(FAULTS)
        }
        self.sides: dict[str, str] = {}
        for pair, name in (rule for rules in self.rounds for rule in rules):
            self.sides[name] = pair
            self.matrices[name] = product(self.matrices[pair[0]], self.matrices[pair[1]])
        self._ropes: dict[tuple[str, int, int], str] = {}
        self._remembered: dict[str, tuple[int, str]] = {}

    def shorten(self, turns: str) -> str:
        for rules in self.rounds:
            for pair, name in rules:
                turns = turns.replace(pair, name)
        return turns

    def edits(self, name: str, i: int, j: int) -> str:
        """The rope of a symbol's entry, as a string."""
        known = self._ropes.get((name, i, j))
        if known is None:
            entry = self.matrices[name].edits[i][j]
            if name in self.sides:
                left, right = self.sides[name]
                known = self.edits(left, i, entry) + self.edits(right, entry, j)
            else:
                known = entry
            self._ropes[name, i, j] = known
        return known

    def repair(self, segments: list[str]) -> tuple[int, str]:
        """Cost and edits of a conversation; its turns in one or more strings."""
        if len(segments) == 1 and len(segments[0]) <= 64:
            known = self._remembered.get(segments[0])
            if known is None:
                if len(self._remembered) >= REMEMBERED:
                    self._remembered.clear()
                known = self._remembered[segments[0]] = self._repair(segments)
            return known
        return self._repair(segments)

    def _repair(self, segments: list[str]) -> tuple[int, str]:
        cost, rank = [0] + [INFINITE] * 3, [0, 1, 2, 3]
        names, before = [self.shorten(x) for x in segments], bytearray()
        for name in names:
            for c in name:
                cost, rank, via = step(cost, rank, self.matrices[c])
                before.append(via[0] | via[1] << 2 | via[2] << 4 | via[3] << 6)
        ends = [
            (cost[j] + more, rank[j], j, edits)
            for j, inserts in enumerate(_inserts())
            for end, (more, edits) in inserts.items()
            if end in (START, ASSISTANT)
        ]
        total, _, state, tail = min(ends)
        out, at = [tail], len(before)
        for name in reversed(names):
            for c in reversed(name):
                at -= 1
                earlier = before[at] >> 2 * state & 3
                out.append(self.edits(c, earlier, state))
                state = earlier
        return total, "".join(reversed(out))


def fit_grammar(strings: DataFrame, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> Grammar:
    """Re-Pair over all strings (turns, n), n being how often each occurs.

    A round counts every pair of neighbours and names up to per_round of the most frequent
    ones that share no symbol, so their replacements don't meet. It ends when no pair occurs
    twice. The driver sees pair counts only; their number is bounded by the rules.
    """
    found: list[list[tuple[str, str]]] = []
    name = _FIRST_RULE
    for _ in range(rounds):
        pairs = (
            strings.filter(F.length("turns") > 1)
            .select(
                "n",
                F.explode(
                    F.transform(
                        F.sequence(F.lit(1), F.length("turns") - 1),
                        lambda i: F.substring(F.col("turns"), i, F.lit(2)),
                    )
                ).alias("pair"),
            )
            .groupBy("pair")
            .agg(F.sum("n").alias("n"))
            .filter("n > 1")
            .orderBy(F.desc("n"), "pair")
            .limit(8 * per_round)
            .collect()
        )
        rules, used = [], set()
        for r in pairs:
            if len(rules) < per_round and not used & set(r.pair):
                used |= set(r.pair)
                rules.append((r.pair, chr(name)))
                name += 1
        if not rules:
            break
        found.append(rules)
        shorter = F.col("turns")
        for pair, to in rules:
            shorter = F.replace(shorter, F.lit(pair), F.lit(to))
        strings = written(strings.select(shorter.alias("turns"), "n"), "turn-strings")
    return Grammar(found)


def _role_class(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    return F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)


def _fault(text: Column) -> Column:
    """Place in FAULTS, duplicates aside."""
    return (
        F.when(~text.rlike(NOT_SPACE), 1).when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), 3).otherwise(0)
    )


def _segments(rows: DataFrame) -> DataFrame:
    """(conv, at, turns): the symbols of each conversation in segments, in the order of at."""
    order = ["conv", "turn", "role", "text_key"]
    ordered = written(
        rows.select(*order, _role_class(F.col("role")).alias("class"), _fault(F.col("text")).alias("fault"))
        .withColumn("salt", F.monotonically_increasing_id())  # equal rows may part
        .repartitionByRange(*order, "salt")
        .sortWithinPartitions(*order, "salt")
        .drop("salt")
        .withColumn("place", F.monotonically_increasing_id()),
        "turn-keys",
    )
    firsts = (
        ordered.filter("fault <> 1").groupBy("conv", "role", "text_key").agg(F.min("place").alias("place"))
    ).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("fault") == 1, 1).when(F.col("first").isNull(), 2).otherwise(F.col("fault"))
    turns = ordered.join(firsts, "place", "left").select(
        "conv",
        F.shiftright("place", SEGMENT_BITS).alias("at"),
        F.struct("place", F.char(65 + 4 * fault + F.col("class")).alias("symbol")).alias("turn"),
    )
    return written(
        turns.groupBy("conv", "at").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list("turn")), lambda t: t["symbol"]), "").alias("turns")
        ),
        "turn-segments",
    )


_CLASSES = {65 + 4 * f + r: role for r, role in enumerate(ROLES) for f in range(len(FAULTS))}


class _Conversation:
    """What is known of the conversation being read: segments first, then its turns."""

    def __init__(self, conv, grammar: Grammar):
        self.conv, self.grammar = conv, grammar
        self.segments: list[str] = []
        self.faults = [0] * len(FAULTS)
        self.illegal, self.last_role = 0, ""
        self.low = self.high = None
        self.distinct = 0
        self.edits: str | None = None
        self.cost = 0
        self.at = 0
        self.emitted = ""

    def segment(self, turns: str) -> None:
        self.segments.append(turns)
        for f in range(len(FAULTS)):
            self.faults[f] += sum(turns.count(symbol(r, f)) for r in range(len(ROLES)))
        roles = self.last_role + turns.translate(_CLASSES)
        self.illegal += len(roles) - 1 - roles.count("su") - roles.count("ua") - roles.count("au")
        self.last_role = roles[-1]

    def solve(self) -> None:
        if self.edits is None:
            self.cost, self.edits = self.grammar.repair(self.segments) if self.segments else (0, "")
            self.segments = []

    def _emit(self, edit: str, role: str | None, text: str):
        role = role or ("assistant" if self.emitted == "u" else "user")
        self.emitted = role[0]
        return edit, role, text

    def inserted(self):
        while self.edits[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._emit("I", None, "")

    def turn(self, turn, role: str, text: str):
        """Repaired turns up to this one."""
        self.solve()
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            yield self._emit(edit, role if edit == "K" else None, text)

    def end(self):
        self.solve()
        yield from self.inserted()

    def gaps(self) -> int:
        missing = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return min(missing, (1 << 63) - 1)


def _conversations(batches, grammar: Grammar) -> Iterator[tuple[_Conversation, Iterator]]:
    """(conversation, its repaired turns); the turns are to be read before the next one."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in ("conv", "kind", "turn", "role", "text", "turns")))

    stream = rows()
    row = next(stream, None)

    def read(open_: _Conversation):
        nonlocal row
        while row is not None and row[0] == open_.conv:
            _, kind, turn, role, text, turns = row
            if kind == 1:
                open_.segment(turns)
            elif kind == 2:
                yield from open_.turn(turn, role, text)
            row = next(stream, None)
        yield from open_.end()

    while row is not None:
        conversation = _Conversation(row[0], grammar)
        yield conversation, read(conversation)


def _reports(batches, grammar: Grammar, names: list[str], kind: pa.DataType):
    out = []

    def batch():
        columns = list(zip(*out))
        kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    held = 0
    for c, turns in _conversations(batches, grammar):
        digest, n = hashlib.sha256(), 0
        for _, role, text in turns:
            digest.update(f"{chr(10) if n else ''}{role}:{text}".encode())
            n += 1
        _, blank, duplicate, truncated = c.faults
        out.append((c.conv, c.gaps(), blank, duplicate, truncated, c.illegal, c.cost, c.edits, digest.hexdigest(), n))
        held += len(c.edits)
        if len(out) >= 2000 or held > 1 << 22:
            yield batch()
            out.clear()
            held = 0
    if out:
        yield batch()


def _repaired_rows(batches, grammar: Grammar, names: list[str], kind: pa.DataType):
    kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
    out, held = [], 0
    for c, turns in _conversations(batches, grammar):
        for place, row in enumerate(turns):
            out.append((c.conv, place, *row))
            held += 64 + len(row[2])
            if held > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)
                out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)


def _streamed(conversations: DataFrame, ids: DataFrame | None) -> tuple[DataFrame, Grammar]:
    """Segments and turns of every conversation together and in order, and the grammar."""
    blank = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
    ).withColumn("text_key", F.unhex(F.md5("text")))
    segments = _segments(rows)
    grammar = fit_grammar(segments.groupBy("turns").agg(F.count("*").alias("n")))
    parts = segments.select("conv", F.lit(1).alias("kind"), "at", "turns").unionByName(
        rows.withColumn("kind", F.lit(2)), allowMissingColumns=True
    )
    if ids is not None:
        named = ids.select(F.col("conv_id").alias("conv"), F.lit(0).alias("kind")).distinct()
        parts = parts.unionByName(named, allowMissingColumns=True)
    order = ["conv", "kind", "at", "turn", "role", "text_key"]
    stream = parts.repartition("conv").sortWithinPartitions(*order)
    return stream.select("conv", "kind", "turn", "role", "text", "turns"), grammar


def _conv_kind(conversations: DataFrame) -> T.StructField:
    return T.StructField("conv_id", conversations.schema["conv_id"].dataType)


def report(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation (conv_id, turn, role, text): faults, cost, edits and a digest.

    The digest is the sha256 of the rows that `repaired` returns, as role:text lines. ids:
    conversations (conv_id) that get a row even if they have no turn.
    """
    stream, grammar = _streamed(conversations, ids)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType(
        [
            _conv_kind(conversations),
            *[T.StructField(x, T.LongType()) for x in counts],
            T.StructField("audit", T.StringType()),
            T.StructField("repaired_sha256", T.StringType()),
            T.StructField("n_repaired", T.LongType()),
        ]
    )
    kind = _arrow_kind(schema[0].dataType)
    return stream.mapInArrow(lambda batches: _reports(batches, grammar, schema.names, kind), schema)


def repaired(conversations: DataFrame) -> DataFrame:
    """The turns after repair: conv_id, place (from 0), edit (K, R or I), role, text."""
    stream, grammar = _streamed(conversations, None)
    schema = T.StructType(
        [_conv_kind(conversations), T.StructField("place", T.LongType())]
        + [T.StructField(x, T.StringType()) for x in ("edit", "role", "text")]
    )
    kind = _arrow_kind(schema[0].dataType)
    return stream.mapInArrow(lambda batches: _repaired_rows(batches, grammar, schema.names, kind), schema)


def _arrow_kind(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def damaged(conversations: DataFrame) -> DataFrame:
    """Damage for trials, by a checksum of conversation and turn modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes
    its role user. Nulls are one space.
    """
    conv, turn = (F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn"))
    text, role = (F.coalesce(F.col(x), F.lit(" ")) for x in ("text", "role"))
    code = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("code"))
        .filter("code <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("code") == 1, "")
            .when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )
