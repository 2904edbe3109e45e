"""Exact duplicates by deterministic block naming.

A text without its white space is cut into blocks of BLOCK bytes. The distinct blocks of all
documents are sorted and a block's name is its place there, an integer. Then pairs of
adjacent names are named the same way, level after level, until every document has one name.
Two documents have the same name at the same level if and only if their texts are equal:
names stand for contents, never for hashes.

A document finds the name of a block by 128 bits of hash instead of carrying the block
through a second shuffle. That the hash tells all distinct blocks apart is counted after
each naming of blocks; if it doesn't, the blocks are named again under another seed.

The text is shuffled once, as distinct blocks (copies are combined in the map tasks).
Everything later has a few integers a row. A level halves what is left, so a document of n
blocks costs about 2n rows and log2(n) levels; there is no bound on its length.

Defined results: a null text counts as empty, and all texts without a visible character are
equal. Of equal texts the row with the most code points stays, then the smallest id (null
last); of rows that repeat id and length, one. A null id is a document like any other. An
empty table gives an empty table. Other columns pass through; columns of the result's names
are replaced.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.llm.text import SPACE, free_name, once
from modelyard.session import written

BLOCK = 4096  # bytes of a block
ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def block_hash(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + k), block) for k in range(2)]


def _blocks(text: Column, wanted) -> Column:
    """wanted(block) of every block of text; an empty text is one empty block."""
    raw = text.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(text) / BLOCK), F.lit(1)).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: wanted(F.substring(raw, i * BLOCK + 1, F.lit(BLOCK))))


def _named(distinct: DataFrame, *keys: str) -> DataFrame:
    """The rows with name: their place after sorting, unique over all partitions."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _first_names(docs: DataFrame, text: str, columns: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows with the hashes a, b of their blocks, names of all blocks by hash)."""
    clean = free_name(docs, "clean")
    base = once(docs, clean, normalised(F.col(f"`{text}`")))
    for seed in count():

        def key(block: Column, seed=seed) -> Column:
            a, b = block_hash(block, seed)
            return F.struct(a.alias("a"), b.alias("b"))

        names = written(
            _named(
                base.select(F.explode(_blocks(F.col(clean), lambda x: F.struct(key(x).alias("h"), x.alias("block")))).alias("x"))
                .select("x.h.a", "x.h.b", "x.block")
                .distinct(),
                "block",
            ).select("a", "b", "name"),
            "block-names",
        )
        total, apart = names.agg(F.count("*"), F.count_distinct("a", "b")).first()
        if total == apart:
            break
    rows = base.select(
        F.monotonically_increasing_id().alias("row"),
        F.sha2(clean, 256).alias("text_sha256"),
        _blocks(F.col(clean), key).alias("hashes"),
        F.struct(*[value.alias(x) for x, value in columns.items()]).alias("doc"),
    )
    return written(rows, "block-rows"), names


def _identities(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(row, level, name): equal for equal texts and for no others."""
    blocks = rows.select("row", F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "h"))
    parts = blocks.select("row", "n", "pos", "h.a", "h.b").join(names, ["a", "b"])
    longest = rows.agg(F.max(F.size("hashes"))).first()[0] or 1
    done = []
    for level in count():
        done.append(parts.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
        if longest == 1:
            break
        longest = (longest + 1) // 2
        side = [F.max(F.when(F.col("pos") % 2 == k, F.col("name"))) for k in range(2)]
        pairs = written(
            parts.filter("n > 1")
            .groupBy("row", F.shiftright("pos", 1).alias("pos"))
            .agg(
                F.first(F.shiftright(F.col("n") + 1, 1)).alias("n"),
                side[0].alias("a"),
                F.coalesce(side[1], F.lit(-1)).alias("b"),  # the odd one at the end
            ),
            "block-pairs",
        )
        names = written(_named(pairs.select("a", "b").distinct(), "a", "b"), "pair-names")
        parts = pairs.join(names, ["a", "b"])
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def mark(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", carried: list[str] | None = None
) -> DataFrame:
    """The carried columns (all of docs unless named) with keep_id, group_size, kept, text_sha256."""
    carried = [x for x in (docs.columns if carried is None else carried) if x.lower() not in ADDED]
    columns = {f"c{k}": F.col(f"`{x}`") for k, x in enumerate(carried)}
    columns |= {"id": F.col(f"`{id_col}`"), "length": F.length(F.coalesce(F.col(f"`{text}`"), F.lit("")))}
    rows, names = _first_names(docs, text, columns)
    names = _identities(rows, names)
    known = rows.select("row", F.col("doc.id").alias("id"), F.col("doc.length").alias("length")).join(names, "row")
    order = F.struct(-F.col("length"), F.col("id").isNull(), F.col("id"), F.col("row"))
    # written, so that the join with it is one of plain shuffles and hot groups are split
    best = written(
        known.groupBy("level", "name").agg(F.count("*").alias("group_size"), F.min(order).alias("best")),
        "block-groups",
    )
    found = known.join(best, ["level", "name"]).select(
        "row",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
    )
    return rows.join(found, "row").select(
        *[F.col(f"doc.c{k}").alias(x) for k, x in enumerate(carried)], "keep_id", "group_size", "kept", "text_sha256"
    )


def kept(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay."""
    marked = mark(docs, id_col, text)
    return marked.filter("kept").select(*[F.col(f"`{x}`") for x in marked.columns[: -len(ADDED)]])
