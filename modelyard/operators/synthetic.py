"""Generator replies to training rows, and the preparation of those rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.functions.numbers import float_text
from modelyard.functions.text import fill
from modelyard.operators.prefix import exclusive_running_total


def gap_prompts(gaps: DataFrame, n_per_gap: int = K.ROWS_PER_GAP) -> DataFrame:
    """Generator prompt per row; an unknown category uses the factual one."""
    n = F.lit(str(n_per_gap))
    prompt = fill(K.GAP_PROMPTS[K.FALLBACK_GAP], n=n)
    for gap, template in K.GAP_PROMPTS.items():
        prompt = F.when(F.col("gap_cat") == gap, fill(template, n=n)).otherwise(prompt)
    return gaps.withColumn("prompt", prompt)


# --- JSON in free text -------------------------------------------------------


def parse_reply(raw: Column) -> Column:
    """The whole text as JSON, else its widest bracketed span, else null."""
    span = F.nullif(F.regexp_extract(raw, r"(?s)\[.*\]", 0), F.lit(""))
    return F.coalesce(F.try_parse_json(raw), F.try_parse_json(span))


def parsed_replies(replies: DataFrame) -> DataFrame:
    """Replies with the parsed value and its number of items.

    An object counts its keys, as a length would; a scalar has no items.
    """
    parsed = replies.withColumn("items", parse_reply(F.col("raw")))
    entries = F.try_variant_get("items", "$", "array<variant>")
    fields = F.try_variant_get("items", "$", "map<string,variant>")
    return parsed.withColumn(
        "n_items", F.coalesce(F.size(entries), F.size(F.map_keys(fields)), F.lit(0))
    )


def _as_text(item: Column, key: str) -> Column:
    """Text of one field: absent -> '', null -> None, booleans capitalised.

    A number written with a point or an exponent is a float and keeps a float's text.
    """
    value = F.try_variant_get(item, f"$.{key}", "variant")
    text = F.try_variant_get(item, f"$.{key}", "string")
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), F.lit(""))
        .when(F.is_variant_null(value), F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(text))
        .when(
            kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"),
            float_text(F.try_variant_get(item, f"$.{key}", "double")),
        )
        .otherwise(text)
    )


def synthetic_rows(replies: DataFrame, *keep: str) -> DataFrame:
    """One row per JSON object in a reply's array; other items are skipped.

    The fields of an item leave a generator, so that what filters or joins them later reads
    the text and does not repeat the look-up.
    """
    fields = F.struct(*[_as_text(F.col("item"), k).alias(k) for k in ("context", "question", "answer")])
    items = F.try_variant_get(parse_reply(F.col("raw")), "$", "array<variant>")
    return (
        # The outer form is parsed once; the plain one would be tested for size first.
        replies.select(*keep, "gap_cat", F.posexplode_outer(items).alias("pos", "item"))
        .filter(F.schema_of_variant("item").startswith("OBJECT"))
        .select(*keep, "pos", "gap_cat", F.inline_outer(F.array(fields)))
        .select(*keep, "pos", "context", "question", "answer", "gap_cat")
    )


def yield_per_gap(replies: DataFrame) -> DataFrame:
    return (
        parsed_replies(replies).groupBy("gap_cat").agg(F.sum("n_items").cast("bigint").alias("n_items"))
    )


# --- training text -----------------------------------------------------------


def chat_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """Training text of complete rows; a row with an empty field is dropped."""
    parts = ["context", "question", "answer"]
    complete = rows
    for part in parts:
        complete = complete.filter(F.col(part) != "")
    text = fill(K.CHAT_TEMPLATE, **{part: F.col(part) for part in parts})
    return complete.select(*keep, text.alias("text"), "gap_cat")


def words(text: Column) -> Column:
    """Whitespace-separated words, the token unit of masking and packing."""
    return F.filter(F.split(text, r"[ \t\n\r\f]+"), lambda w: w != "")


def response_mask(chats: DataFrame, *keep: str) -> DataFrame:
    """Words with their place and whether they follow the last response marker."""
    marker = K.CHAT_MARKER
    spoken = F.when(
        F.contains("text", F.lit(marker)),
        F.size(words(F.substring_index("text", marker, -1))),
    ).otherwise(0)
    return (
        chats.select(*keep, words(F.col("text")).alias("w"), spoken.alias("spoken"))
        .select(
            *keep,
            (F.size("w") - F.col("spoken")).alias("from"),
            F.posexplode_outer("w").alias("pos", "token"),
        )
        .filter(F.col("token").isNotNull())
        .select(*keep, "pos", "token", (F.col("pos") >= F.col("from")).alias("in_loss"))
    )


def pack_segments(chats: DataFrame, order: str, window: int = K.MAX_SEQ_LENGTH) -> DataFrame:
    """Cut the running word stream into windows: the runs each row gives to each.

    Rows are laid end to end by ``order``; a row that crosses a boundary gives a
    run to every window it touches.
    """
    sized = chats.select(order, words(F.col("text")).alias("tokens")).withColumn(
        "n_tokens", F.size("tokens").cast("bigint")
    )
    placed = exclusive_running_total(
        sized.select(order, "n_tokens"), order, "n_tokens", "at"
    ).filter(F.col("n_tokens") > 0)
    w = F.lit(window).cast("bigint")
    first = F.floor(F.col("at") / w)
    last = F.floor((F.col("at") + F.col("n_tokens") - 1) / w)
    runs = (
        placed.withColumn("window_id", F.explode(F.sequence(first, last)))
        .withColumn("seg_from", F.greatest(F.col("at"), F.col("window_id") * w) - F.col("at"))
        .withColumn(
            "seg_len",
            F.least(F.col("at") + F.col("n_tokens"), (F.col("window_id") + 1) * w)
            - F.col("at")
            - F.col("seg_from"),
        )
        .select(order, "window_id", "seg_from", "seg_len")
    )
    return runs


def packed_windows(chats: DataFrame, order: str, window: int = K.MAX_SEQ_LENGTH) -> DataFrame:
    """Text of every window; a window gathers at most ``window`` words."""
    runs = pack_segments(chats, order, window)
    # texts and cut texts are shuffled, not lists of words, which take about three times the bytes
    cut = runs.join(chats.select(order, "text"), order).select(
        order,
        "window_id",
        F.slice(
            words(F.col("text")), (F.col("seg_from") + 1).cast("int"), F.col("seg_len").cast("int")
        ).alias("part"),
    )
    cut = cut.select(order, "window_id", F.size("part").alias("n"), F.nullif(F.array_join("part", " "), F.lit("")).alias("part"))
    return cut.groupBy("window_id").agg(
        F.sum("n").alias("n_tokens"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct(order, "part"))), lambda s: s["part"]), " "
        ).alias("text"),
    )


def length_batches(chats: DataFrame, order: str, batch_size: int = K.TRAIN_BATCH) -> DataFrame:
    """Batch numbers over rows sorted by length, ties by ``order``."""
    sized = chats.select(order, F.size(words(F.col("text"))).alias("n_tokens"), F.lit(1).alias("one"))
    placed = exclusive_running_total(sized, order, "one", "place", group="n_tokens")
    return placed.select(
        order, "n_tokens", F.floor(F.col("place") / batch_size).alias("batch_id")
    )


# --- improvement loop --------------------------------------------------------


ITERATION_BLOCK = 65_536


def loop_decisions(history: DataFrame, target: float = K.TARGET_ROUGE) -> DataFrame:
    """Where each loop stops and why, and the best score up to there.

    Expects ``loop_id, iteration, avg_rouge1, n_gaps, n_syn`` with unique iterations
    per loop. The stop is found by a minimum that combines map-side. It is joined
    back on the loop and a block of iterations, so a loop with a third of all rows
    still spreads over many tasks; a loop shorter than a block has one row there.
    """
    reason = (
        F.when(F.col("avg_rouge1") >= target, "target reached")
        .when(F.col("n_gaps") == 0, "no gaps")
        .when(F.col("n_syn") == 0, "no synthetic rows")
    )
    block = F.floor(F.col("iteration") / ITERATION_BLOCK)
    stops = (
        history.withColumn("reason", reason)
        .groupBy("loop_id")
        .agg(
            F.min(F.when(F.col("reason").isNotNull(), F.struct("iteration", "reason"))).alias("stop"),
            F.min(block).alias("first"),
            F.max(block).alias("last"),
        )
        .select(
            "loop_id",
            F.col("stop.iteration").alias("stopped_at"),
            F.col("stop.reason").alias("reason"),
            F.explode(F.sequence("first", "last")).alias("block"),
        )
    )
    ran = (
        history.select("loop_id", "iteration", "avg_rouge1", block.alias("block"))
        .join(stops, ["loop_id", "block"])
        .filter(F.col("stopped_at").isNull() | (F.col("iteration") <= F.col("stopped_at")))
    )
    return ran.groupBy("loop_id").agg(
        F.max("stopped_at").alias("stopped_at"),
        F.coalesce(F.max("reason"), F.lit("iterations used up")).alias("reason"),
        F.count("*").alias("iterations"),
        F.max("avg_rouge1").alias("best_rouge1"),
    )
