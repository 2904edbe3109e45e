"""Near-duplicate texts: Jaccard similarity of word 5-grams, joined along chosen paths.

Each distinct text becomes a set of tokens (position, MinHash value): two sets share a
token at a position with a probability equal to their similarity. A run starts with all
sets in one bucket and splits it on CHILDREN sampled positions: sets that share the token
there go on together. Buckets that are small, that splitting no longer divides, or that are
at the last level are compared by brute force, in tiles and with exact shingle sets. Runs
repeat until the target recall, averaged over how many of the positions a pair agrees in.

Every pair is counted in one bucket only (the least one its sets share), so a text's links
are exact. Equal texts are joined once and counted as often as they occur.

A tile ships sketches of at most 2 * TILE sets. Where shingle sets are compared, tiles are cut
again so that a part has some 2 * TILE_SHINGLES shingles, or two sets if those have more: no
row holds more than that, however long the texts are. A text is one set of 8 bytes a word.

Defined results: null texts and texts without words link with nothing and are their own
component, as are rows with a null id. Texts of fewer than five words have one shingle,
the whole text. Repeated rows are copies. An empty table gives an empty table. Extra
columns pass through; columns of the result's names are replaced. Ids are unique to a
document: rows that repeat an id and its text are copies that share that id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.llm import shingles as S
from modelyard.llm.components import components
from modelyard.llm.features import portions
from modelyard.llm.links import forest, tiles
from modelyard.llm.text import free_name
from modelyard.session import written

THRESHOLD = (4, 5)  # least similarity, as a fraction
CHILDREN = 2
TARGET_RECALL = 0.99998
LEVELS = 4
SMALL = 32  # buckets up to this size are not split
ALIKE = 0.5  # a child with this share of its parent's sets shows that they are alike
TILE = 4096  # sets in a block of sketches
TILE_SHINGLES = 1 << 20  # shingles in a block of sets
SLOTS = 24  # bits of a slot in the bitmap of ids: 2 MB
TEXT_BYTES = 1 << 20  # of texts made into sets at once
SIDE = 256  # sets compared at once in a task
SCREEN = 34  # of 64 equal positions; at similarity 0.8 fewer have probability below 1e-6
ADDED = ("class_id", "n_links", "component_id", "kept")


def runs_needed(recall: float = TARGET_RECALL, children: int = CHILDREN, levels: int = LEVELS) -> int:
    """Runs until a pair at the threshold is found with the wanted probability.

    A pair agrees in a number of positions that is binomial; given that share p, its line
    dies out within k levels with probability lost = (1 - p + p * lost) ** children, lost
    being 0 at the last level. All runs draw from the same positions.
    """
    s, n = THRESHOLD[0] / THRESHOLD[1], S.POSITIONS
    chance, lost = [], []
    for agree in range(n + 1):
        chance.append(math.comb(n, agree) * s**agree * (1 - s) ** (n - agree))
        dead, p = 0.0, agree / n
        for _ in range(levels):
            dead = (1 - p + p * dead) ** children
        lost.append(dead)
    runs = 1
    while sum(c * x**runs for c, x in zip(chance, lost)) > 1 - recall:
        runs += 1
    return runs


def _sketches(batches):
    hashes = S.WordHashes()
    for batch in batches:
        sizes, sketches = [], []
        for text in batch.column("text"):
            x = S.shingle_set(text.as_py(), hashes)
            sizes.append(len(x))
            sketches.append(S.sketch(x))
        offsets = np.arange(len(sizes) + 1, dtype=np.int32) * S.POSITIONS
        values = np.array(sketches, np.int32).reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("k1"),
                batch.column("k2"),
                pa.array(sizes, pa.int32()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            ],
            names=["id", "k1", "k2", "size", "sketch"],
        )


def _sets(batches):
    hashes = S.WordHashes()
    for whole in batches:
        for batch in portions(whole, "text", TEXT_BYTES):
            rows = [S.shingle_set(t.as_py(), hashes).view(np.int64) for t in batch.column("text")]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))],
                names=["rep", "shingles"],
            )


def _children(path: Column) -> Column:
    """The child paths of a node for a set: two distinct positions, and the set's values there."""
    h = F.xxhash64(path)
    first, stride = F.pmod(h, F.lit(S.POSITIONS)), F.pmod(F.shiftrightunsigned(h, 17), F.lit(S.POSITIONS // 2))
    places = [F.pmod(first + k * (2 * stride + 1), F.lit(S.POSITIONS)) for k in range(CHILDREN)]
    return F.array(*[F.xxhash64(path, p, F.get(F.col("sketch"), p.cast("int"))) for p in places])


def buckets(sets: DataFrame, runs: int, small: int = SMALL, levels: int = LEVELS) -> DataFrame:
    """Leaf buckets (rep, path, n) with two or more sets (rep, sketch)."""
    roots = F.array(*[F.xxhash64(F.lit("run"), F.lit(r)) for r in range(runs)])
    nodes = sets.select(
        "rep", "sketch", F.explode(roots).alias("path"), F.lit(None).cast("bigint").alias("parent_n")
    )
    leaves = []
    for level in range(1, levels + 1):
        grown = nodes.select("rep", "parent_n", F.explode(_children(F.col("path"))).alias("path"))
        sizes = grown.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
        shared = written(grown.join(sizes, "path").select("rep", "path", "n", "parent_n"), "bucket-level")
        done = (F.col("n") <= small) | F.coalesce(F.col("n") >= F.col("parent_n") * ALIKE, F.lit(False))
        if level == levels:
            done = F.lit(True)
        leaves.append(shared.filter(done).select("rep", "path", "n"))
        nodes = shared.filter(~done).select("rep", "path", F.col("n").alias("parent_n"))
        if level < levels and nodes.isEmpty():
            break
        nodes = nodes.join(sets, "rep")
    out = leaves[0]
    for x in leaves[1:]:
        out = out.unionByName(x)
    return out


def _in_tiles(members: DataFrame, *carried: str) -> DataFrame:
    """One row per tile with its members (rep, block, *carried): at most two blocks."""
    tiled = members.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn(
        "tile", F.explode(tiles(F.col("blocks"), F.col("block")))
    )
    return tiled.groupBy("path", "tile").agg(
        F.collect_list(F.struct("rep", "block", *carried)).alias("members")
    )


def common(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Matrix of the numbers of values that sets on the left and on the right share."""
    both = np.zeros((len(left), len(right)), np.float32)
    owner = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    flat = [np.concatenate(x) for x in (left, right)]
    values = np.intersect1d(*flat)  # a value of one side alone adds nothing
    for begin in range(0, len(values), columns):
        part, held = values[begin : begin + columns], []
        for o, f in zip(owner, flat):
            code = np.minimum(np.searchsorted(part, f), len(part) - 1)
            hit = part[code] == f
            side = np.zeros((len(both) if o is owner[0] else len(right), len(part)), np.float32)
            side[o[hit], code[hit]] = 1
            held.append(side)
        both += held[0] @ held[1].T
    return both


def _owned(left: list[np.ndarray], right: list[np.ndarray], path: int) -> np.ndarray:
    """Pairs that share no bucket below path."""
    return common([o[o < path] for o in left], [o[o < path] for o in right]) == 0


def _sides(block: np.ndarray, tile: tuple[int, int], sub: np.ndarray | None = None, part: tuple[int, int] = (0, 0)):
    """(left places, right places, pairs to compare) of a tile, SIDE by SIDE, each pair once."""
    places = np.arange(len(block))
    first, second = (places, places) if tile[0] == tile[1] else (places[block == tile[0]], places[block == tile[1]])
    for i in range(0, len(first), SIDE):
        for j in range(i if tile[0] == tile[1] else 0, len(second), SIDE):
            a, b = first[i : i + SIDE], second[j : j + SIDE]
            pairs = a[:, None] < b[None, :] if tile[0] == tile[1] else np.ones((len(a), len(b)), bool)
            if sub is not None:
                low, high = np.minimum(sub[a][:, None], sub[b][None, :]), np.maximum(sub[a][:, None], sub[b][None, :])
                pairs = pairs & (low == part[0]) & (high == part[1])
            if pairs.any():
                yield a, b, pairs


def _tiles_of(batch: pa.RecordBatch, *names: str):
    """(row, rep, block, *lists) of every tile row; lists are arrays per member."""
    members = batch.column("members")
    flat = members.flatten()
    rep, block = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("rep", "block"))
    lists = []
    for name in names:
        field = flat.field(name)
        if pa.types.is_list(field.type):
            values = field.values.to_numpy(zero_copy_only=False)
            offsets = field.offsets.to_numpy()
            lists.append([values[a:b] for a, b in zip(offsets[:-1], offsets[1:])])
        else:
            lists.append(field.to_numpy(zero_copy_only=False))
    at = 0
    for row in range(batch.num_rows):
        end = at + len(members[row])
        yield row, rep[at:end], block[at:end], *[x[at:end] for x in lists]
        at = end


def _screen(batches):
    """Members of a tile with a partner that is owned there and has a similar sketch."""
    for batch in batches:
        out = []
        for row, rep, block, sketch, owners in _tiles_of(batch, "sketch", "owners"):
            path, tile = batch.column("path")[row].as_py(), batch.column("tile")[row].as_py()
            values, wanted = np.stack(sketch), np.zeros(len(rep), bool)
            for a, b, pairs in _sides(block, (tile["first"], tile["second"])):
                left, right = values[a], values[b]
                equal = np.zeros(pairs.shape, np.uint8)
                for k in range(values.shape[1]):
                    equal += left[:, k][:, None] == right[:, k][None, :]
                pairs = pairs & (equal >= SCREEN)
                if pairs.any():
                    pairs &= _owned([owners[x] for x in a], [owners[x] for x in b], path)
                    wanted[a[pairs.any(axis=1)]] = True
                    wanted[b[pairs.any(axis=0)]] = True
            if wanted.any():
                out.append((path, tile, rep[wanted], block[wanted]))
        if out:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([p for p, _, _, _ in out], [len(r) for _, _, r, _ in out])),
                    pa.array([t["first"] for _, t, r, _ in out for _ in r], pa.int32()),
                    pa.array([t["second"] for _, t, r, _ in out for _ in r], pa.int32()),
                    pa.array(np.concatenate([r for _, _, r, _ in out])),
                    pa.array(np.concatenate([b for _, _, _, b in out]).astype(np.int32)),
                ],
                names=["path", "first", "second", "rep", "block"],
            )


def similar(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of pairs whose sets have at least the threshold's similarity, counted exactly."""
    both = common(left, right).astype(np.float64)
    sizes = [np.array([len(s) for s in x]) for x in (left, right)]
    union = sizes[0][:, None] + sizes[1][None, :] - both
    return THRESHOLD[1] * both >= THRESHOLD[0] * union


def _verify(batches):
    """Links per member, and a spanning forest, of the pairs owned by a part of a tile."""
    for batch in batches:
        parts = []
        for row, rep, block, sub, copies, owners, sets in _tiles_of(batch, "sub", "copies", "owners", "shingles"):
            path, n = batch.column("path")[row].as_py(), len(rep)
            tile, part = ((x["first"], x["second"]) for x in (batch.column("tile")[row].as_py(), batch.column("part")[row].as_py()))
            count, child, root = np.zeros(n), np.empty(0, int), np.empty(0, int)
            for a, b, pairs in _sides(block, tile, sub, part):
                pairs = pairs & _owned([owners[x] for x in a], [owners[x] for x in b], path)
                rows, columns = np.flatnonzero(pairs.any(axis=1)), np.flatnonzero(pairs.any(axis=0))
                if not len(rows):
                    continue
                a, b, pairs = a[rows], b[columns], pairs[np.ix_(rows, columns)]
                pairs &= similar([sets[x] for x in a], [sets[x] for x in b])
                left, right = np.nonzero(pairs)
                left, right = a[left], b[right]
                count += np.bincount(left, copies[right], n) + np.bincount(right, copies[left], n)
                child, root = forest(np.concatenate([child, left]), np.concatenate([root, right]), n)
            linked = np.flatnonzero(count)
            if len(linked):
                parts.append((rep[linked], rep[linked], count[linked]))
                parts.append((rep[child], rep[root], np.zeros(len(child))))
        if parts:
            a, b, n = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], names=["a", "b", "n"])


def _likely(texts: DataFrame, needed: DataFrame) -> DataFrame:
    """texts without most rows whose rep is not needed, before they are shuffled.

    A bitmap of hashed ids, at most 2^SLOTS / 64 words however many ids there are, is sent
    to the texts. It only thins them out; the join that follows decides.
    """
    slot = F.pmod(F.xxhash64(F.lit(9), "rep"), F.lit(1 << SLOTS))
    word, bit = F.shiftright(slot, 6), F.pmod(slot, F.lit(64)).cast("int")
    words = needed.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("mask"))
    marked = texts.withColumn("word", word).join(F.broadcast(words), "word")
    return marked.filter(F.call_function("getbit", "mask", bit) == 1).select("rep", "text")


def _found(sets: DataFrame, texts: DataFrame, recall: float) -> DataFrame:
    """Rows (a, a, links) and (a, b, 0): links of each set, and a forest of them."""
    leaves = buckets(sets.select("rep", "sketch"), runs_needed(recall))
    owners = leaves.groupBy("rep").agg(F.sort_array(F.collect_list("path")).alias("owners"))
    owners = owners.join(sets, "rep")  # at most runs * CHILDREN ** LEVELS paths each
    members = leaves.join(owners, "rep").withColumn("blocks", F.ceil(F.col("n") / TILE).cast("int"))
    wanted = written(
        _in_tiles(members, "sketch", "owners").mapInArrow(
            _screen, "path bigint, first int, second int, rep bigint, block int"
        ),
        "bucket-candidates",
    )
    needed = wanted.select("rep").distinct()
    shingled = (
        _likely(texts, needed)
        .join(needed, "rep")  # a semi join would be pushed below the bitmap
        .dropDuplicates(["rep"])
        .mapInArrow(_sets, "rep bigint, shingles array<bigint>")
    )
    full = shingled.join(owners.select("rep", "copies", "owners"), "rep")
    tile = F.struct("first", "second")
    weights = written(  # so that the join with it is one of plain shuffles and hot tiles are split
        wanted.join(sets.select("rep", "size"), "rep")
        .groupBy("path", tile.alias("tile"))
        .agg(F.ceil(F.sum("size") / TILE_SHINGLES).cast("int").alias("parts")),
        "tile-weights",
    )
    dealt = (
        wanted.select("path", tile.alias("tile"), "rep", "block")
        .join(weights, ["path", "tile"])
        .withColumn("sub", F.pmod(F.xxhash64(F.lit(3), "rep"), F.col("parts")).cast("int"))
        .withColumn("part", F.explode(tiles(F.col("parts"), F.col("sub"))))
    )
    rows = (
        dealt.join(full, "rep")
        .groupBy("path", "tile", "part")
        .agg(F.collect_list(F.struct("rep", "block", "sub", "copies", "owners", "shingles")).alias("members"))
    )
    return written(rows.mapInArrow(_verify, "a bigint, b bigint, n bigint"), "jaccard-links")


def join(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", recall: float = TARGET_RECALL
) -> DataFrame:
    """docs with class_id, n_links, component_id and kept.

    class_id is the least id with the same text, n_links the number of other documents
    linked directly (copies included), component_id the least id reached by links, and kept
    marks the row that stands for its component.
    """
    rows = docs.filter(F.col(id_col).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(F.lit(1), text).alias("k1"),
        F.xxhash64(F.lit(2), text).alias("k2"),
        F.col(text).alias("text"),
    )
    sketched = rows.mapInArrow(_sketches, "id bigint, k1 bigint, k2 bigint, size int, sketch array<int>")
    classes = written(
        sketched.filter("size > 0")
        .groupBy("k1", "k2")
        .agg(
            F.min("id").alias("rep"),
            F.count("*").alias("copies"),
            F.first("size").alias("size"),
            F.first("sketch").alias("sketch"),
        ),
        "text-classes",
    )
    texts = rows.select(F.col("id").alias("rep"), "text")
    found = _found(classes.select("rep", "copies", "size", "sketch"), texts, recall)
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    groups = components(found.select("a", "b").filter("a <> b")).withColumnRenamed("id", "rep")
    known = (
        classes.join(links, "rep", "left")
        .join(groups, "rep", "left")
        .select(
            "k1",
            "k2",
            "rep",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    k1, k2, rep, n, c = (free_name(docs, x) for x in ("k1", "k2", "rep_id", "rep_links", "rep_component"))
    f1, f2 = free_name(docs, "k1_found"), free_name(docs, "k2_found")
    known = known.toDF(f1, f2, rep, n, c)
    keyed = docs.withColumn(k1, F.xxhash64(F.lit(1), text)).withColumn(k2, F.xxhash64(F.lit(2), text))
    usable = F.col(id_col).isNotNull() & F.col(text).isNotNull()
    joined = keyed.join(
        known, (F.col(k1) == F.col(f1)) & (F.col(k2) == F.col(f2)) & usable, "left"
    )
    own = F.col(id_col).cast("bigint")
    component = F.coalesce(F.col(c), own)
    rest = [F.col(f"`{x}`") for x in docs.columns if x.lower() not in ADDED]
    return joined.select(
        *rest,
        F.coalesce(F.col(rep), own).alias("class_id"),
        F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        own.eqNullSafe(component).alias("kept"),
    )
