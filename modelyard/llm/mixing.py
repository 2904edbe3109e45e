"""Mixing sources to target weights with a low-discrepancy schedule.

Slot n of the schedule takes the point frac(n * golden ratio), which falls into one
source's stretch of the cumulative target weights. The k-th slot of a source serves the
k-th block of BLOCK words of that source, whose documents are laid end to end in a
hash-shuffled order and repeated up to MAX_REPEATS times. A source's last slot is short,
so that its words equal its rounded target.

Every total is built in two levels (rows per small piece, then pieces), so no window holds
a whole source. Up to TREE_SOURCES sources, their stretches are an expression; more of them
are ranked, capped and laid out as a table, and slots find their stretch by a join.

Defined results: a null text has no words and serves none; a null source is a source of
its own, last in order; repeated rows are separate documents; ties in the shuffled order
are broken by doc_id, and rows that still tie are alike. An empty table gives an empty
table. Sources without words have target 0. Extra columns pass through `mix`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modelyard.llm.text import free_name, words
from modelyard.session import settled, written

GOLDEN = (math.sqrt(5) - 1) / 2
BLOCK = 1024
MAX_REPEATS = 3
TREE_SOURCES = 4096
SLOT_PIECE = 1 << 15
ROWS_PER_PIECE = 4096


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def weights_in_order(names: list[str | None]) -> dict[str | None, int]:
    """1, 2, 3, repeating, by code point; null last."""
    ordered = sorted(names, key=lambda s: (s is None, s or ""))
    return {name: 1 + i % 3 for i, name in enumerate(ordered)}


def targets(
    sizes: dict[str | None, int], weights: dict[str | None, int], limit: int = MAX_REPEATS
) -> dict[str | None, float]:
    """Share the total by weight; none above limit times its size; the excess is shared again."""
    left, free, out = float(sum(sizes.values())), set(sizes), {}
    while free:
        weight = sum(weights[s] for s in free)
        full = [s for s in free if left * weights[s] / weight > limit * sizes[s]]
        if not full:
            out |= {s: left * weights[s] / weight for s in free}
            break
        for s in full:
            out[s] = float(limit * sizes[s])
        left -= sum(out[s] for s in full)
        free -= set(full)
    return out


def _stretch(u: Column, edges: list[tuple[int, float]]) -> Column:
    """The source whose stretch holds u: a balanced tree of comparisons with the upper edges."""
    if len(edges) == 1:
        return F.lit(edges[0][0])
    half = len(edges) // 2
    return F.when(u < edges[half - 1][1], _stretch(u, edges[:half])).otherwise(
        _stretch(u, edges[half:])
    )


def _dealt_by_tree(spark: SparkSession, goal: dict[int, int], slots: int) -> DataFrame:
    """Slots (slot, source_no) by comparing their point with the few edges."""
    total, edges, at = sum(goal.values()), [], 0
    for s in sorted(goal):
        at += goal[s]
        edges.append((s, at / total))
    point = (F.col("id") * F.lit(GOLDEN)) % 1
    return spark.range(slots).select(F.col("id").alias("slot"), _stretch(point, edges).alias("source_no"))


def _dealt_by_join(goals: DataFrame, slots: int) -> DataFrame:
    """Slots (slot, source_no) by a join with the stretches of any number of sources.

    The unit interval is cut into as many cells as there are slots. A stretch is filed under
    the cells it touches, so there are as many rows as cells and sources together; golden
    points are even, so a cell has a few slots, and a slot meets the sources of one cell.
    """
    piece = Window.partitionBy("piece").orderBy("source_no")
    pieces = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # a row per 4,096 sources
    cut = goals.withColumn("piece", F.floor(F.col("source_no") / TREE_SOURCES))
    starts = cut.groupBy("piece").agg(F.sum("goal").alias("n")).select(
        "piece", F.coalesce(F.sum("n").over(pieces), F.lit(0)).alias("start")
    )
    total = goals.agg(F.sum("goal")).first()[0]
    high = (F.col("start") + F.sum("goal").over(piece)).cast("double")
    stretches = cut.join(starts, "piece").withColumn("high", high).select(
        "source_no", ((F.col("high") - F.col("goal")) / total).alias("low"), (F.col("high") / total).alias("high")
    )

    def cell(point: Column) -> Column:
        return F.least(F.floor(point * slots), F.lit(slots - 1)).cast("bigint")

    filed = stretches.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    point = (F.col("slot") * F.lit(GOLDEN)) % 1
    numbered = goals.sparkSession.range(slots).withColumnRenamed("id", "slot").withColumn("point", point)
    return (
        numbered.withColumn("cell", cell(F.col("point")))
        .join(filed, "cell")
        .filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
        .select("slot", "source_no")
    )


def schedule(
    spark: SparkSession, goal: dict[int, int] | DataFrame, block: int = BLOCK
) -> DataFrame:
    """Slots (slot, source_no, block_no, served): the words each slot serves, none empty.

    goal: words by source number, or a table (source_no, goal) of them. One golden point per
    block of the total; slots of a source beyond its goal are skipped, and the few blocks that
    the points' discrepancy leaves unserved follow at the end.
    """
    if isinstance(goal, DataFrame):
        goals = goal.filter("goal > 0")
        slots = -(-(goals.agg(F.sum("goal")).first()[0] or 0) // block)
        dealt = _dealt_by_join(goals, slots) if slots else None
    else:
        goal = {s: g for s, g in goal.items() if g > 0}
        goals = spark.createDataFrame(sorted(goal.items()), "source_no int, goal bigint")
        slots = -(-sum(goal.values()) // block)
        dealt = _dealt_by_tree(spark, goal, slots) if slots else None
    if dealt is None:
        return spark.createDataFrame([], "slot bigint, source_no int, block_no bigint, served bigint")
    numbered = dealt.withColumn("piece", F.floor(F.col("slot") / SLOT_PIECE))
    within = Window.partitionBy("source_no", "piece").orderBy("slot")
    before = Window.partitionBy("source_no").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = numbered.groupBy("source_no", "piece").agg(F.count("*").alias("n"))
    starts = pieces.select(
        "source_no", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    ranked = (
        numbered.withColumn("local", F.row_number().over(within) - 1)
        .join(starts, ["source_no", "piece"])
        .select("slot", "source_no", (F.col("start") + F.col("local")).alias("block_no"))
    )
    needed = F.ceil(F.col("goal") / block).cast("bigint")
    reached = pieces.groupBy("source_no").agg(F.sum("n").alias("reached"))
    tail = (
        goals.join(reached, "source_no", "left")
        .withColumn("reached", F.coalesce("reached", F.lit(0)))
        .filter(F.col("reached") < needed)
        .select(
            F.lit(slots).cast("bigint").alias("slot"),
            "source_no",
            F.explode(F.sequence(F.col("reached"), needed - 1)).alias("block_no"),
        )
    )
    return (
        ranked.unionByName(tail)
        .join(goals, "source_no")
        .withColumn("served", F.least(F.lit(block), F.col("goal") - F.col("block_no") * block))
        .filter(F.col("served") > 0)
        .select("slot", "source_no", "block_no", "served")
    )


def _laid_out(sized: DataFrame, pieces: int) -> DataFrame:
    """Add at: the words before the document in its source's shuffled order.

    Order within a source: piece of the hash, hash, doc_id. Sums run within small pieces
    and over the pieces' totals.
    """
    placed = sized.withColumn("mix_hash", F.xxhash64(F.lit(17), "doc_id", "row_key")).withColumn(
        "piece", F.pmod(F.shiftrightunsigned("mix_hash", 20), F.lit(pieces))
    )
    within = (
        Window.partitionBy("source_no", "piece")
        .orderBy("mix_hash", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = Window.partitionBy("source_no").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("source_no", "piece")
        .agg(F.sum("size").alias("n"))
        .select("source_no", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    number = Window.partitionBy("source_no", "piece").orderBy("mix_hash", "doc_id", "size")
    return (
        placed.withColumn("local", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .withColumn("line", F.row_number().over(number))
        .join(starts, ["source_no", "piece"])
        .withColumn("at", F.col("start") + F.col("local"))
        .drop("start", "local", "mix_hash")
    )


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """row_key (of id, source and text), doc_id, source and size; written once."""
    return settled(
        docs.select(
            F.xxhash64("doc_id", "source", text).alias("row_key"),
            "doc_id",
            "source",
            word_count(F.col(text)).alias("size"),
        )
    )


def _few(spark: SparkSession, rows: list, limit: int) -> tuple[DataFrame, dict[int, int]]:
    """Facts of the sources, and their goals by number."""
    total = {r["source"]: r["size"] for r in rows}
    target = targets(total, weights_in_order(list(total)), limit)
    order = sorted(total, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(order)}
    # rounding never passes the limit: a target at the limit is whole
    goal = {number[s]: min(round(target[s]), limit * total[s]) for s in order}
    facts = spark.createDataFrame(
        [(s, number[s], total[s], float(target[s])) for s in order],
        "source string, source_no int, source_size bigint, target double",
    )
    return facts, goal


def _many(found: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The same as tables, for any number of sources (source, size).

    Numbers come from a range sort and the partitions' counts. Targets are capped round by
    round as in ``targets``; a round is one aggregation that brings two sums to the driver.
    """
    order = F.col("source").asc_nulls_last()
    placed = written(
        found.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id()),
        "mix-sources",
    )
    part = F.shiftright("at", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first")).select(
        "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    ranked = written(
        placed.withColumn("part", part)
        .join(starts, "part")
        .select("source", (F.col("start") + F.col("at") - F.col("first")).cast("int").alias("source_no"), F.col("size").alias("source_size")),
        "mix-ranks",
    )
    weight, cap = 1 + F.col("source_no") % 3, F.col("source_size") * limit
    total, free = ranked.agg(F.sum("source_size"), F.sum(weight)).first()
    left, capped = float(total), -1
    while True:
        share = F.lit(left) * weight / F.lit(float(free or 1))
        full = share > cap
        now, taken, rest = ranked.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~full, weight)), F.lit(0))
        ).first()
        if now == capped:
            break
        capped, left, free = now, float(total - taken), rest
    target = F.when(full, cap.cast("double")).otherwise(share)
    facts = ranked.withColumn("target", target)
    goals = facts.select("source_no", F.least(F.bround("target", 0).cast("bigint"), cap).alias("goal"))
    return facts, goals


def allot(sized: DataFrame, block: int = BLOCK, limit: int = MAX_REPEATS) -> DataFrame:
    """sized with source_size, target (its source's) and taken (words of the row in the mix)."""
    spark = sized.sparkSession
    found = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    rows = found.limit(TREE_SOURCES + 1).collect()
    if len(rows) > TREE_SOURCES:
        facts, goal = _many(found.drop("n"), limit)
        n_rows = sized.count()
    else:
        facts, goal = _few(spark, rows, limit)
        n_rows = sum(r["n"] for r in rows)
    pieces = max(1, n_rows // ROWS_PER_PIECE)
    joined = sized.join(
        facts.withColumnRenamed("source", "fact_source"),
        F.col("source").eqNullSafe(F.col("fact_source")),
    ).drop("fact_source")
    laid = _laid_out(joined, pieces)
    # the blocks of each pass over the source that the document's words fall into
    begin = F.col("at") + F.col("source_size") * F.col("pass")
    spans = (
        laid.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(limit - 1))))
        .withColumn("begin", begin)
        .filter((F.col("size") > 0) & (F.col("begin") < F.ceil(F.col("target"))))
        .withColumn(
            "block_no",
            F.explode(
                F.sequence(
                    F.floor(F.col("begin") / block),
                    F.floor((F.col("begin") + F.col("size") - 1) / block),
                )
            ),
        )
        .select("source_no", "piece", "line", "begin", "size", "block_no")
    )
    served = schedule(spark, goal, block).select("source_no", "block_no", "served")
    low, high = F.col("block_no") * block, F.col("block_no") * block + F.col("served")
    taken = (
        spans.join(served, ["source_no", "block_no"])
        .groupBy("source_no", "piece", "line")
        .agg(
            F.sum(
                F.greatest(
                    F.least(F.col("begin") + F.col("size"), high) - F.greatest("begin", low), F.lit(0)
                )
            ).alias("taken")
        )
    )
    return laid.join(taken, ["source_no", "piece", "line"], "left").select(
        *sized.columns, "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )


def mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mixed corpus: documents repeated as often as the mix takes them, same columns.

    A document taken k times whole and then in part gives k whole rows and one row with its
    first words, joined by spaces. Documents that the mix does not take are left out.
    """
    names = [free_name(docs, n) for n in ("row_key", "row_size", "copy_no", "row_taken", "pass")]
    key, size, copy, took, times = names
    rows = docs.withColumn(key, F.xxhash64("doc_id", "source", text)).withColumn(
        size, word_count(F.col(text))
    )
    plan = allot(sizes(docs, text)).filter(F.col("taken") > 0).select(
        F.col("row_key").alias(key), F.col("size").alias(size), F.col("taken").alias(took)
    )
    alike = Window.partitionBy(key, size)
    plan = plan.withColumn(copy, F.row_number().over(alike.orderBy(F.desc(took))))
    rows = rows.withColumn(copy, F.row_number().over(alike.orderBy(size)))
    chosen = rows.join(plan, [key, size, copy]).withColumn(
        times, F.explode(F.sequence(F.lit(1), F.ceil(F.col(took) / F.col(size)).cast("int")))
    )
    left = F.least(F.col(took) - (F.col(times) - 1) * F.col(size), F.col(size))
    cut = F.when(left == F.col(size), F.col(text)).otherwise(
        F.array_join(F.slice(words(F.col(text)), 1, left.cast("int")), " ")
    )
    return chosen.withColumn(text, cut).select(*[F.col(f"`{c}`") for c in docs.columns])
