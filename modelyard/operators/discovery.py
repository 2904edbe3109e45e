"""Finding and ranking candidate models from a registry table.

The registry may be large; everything after the per-keyword cut is bounded by
(number of keywords x ``per_keyword``), both known when the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.functions.numbers import fixed, grouped, parse_float
from modelyard.session import settled


def category_keywords(
    categories: dict[str, list[str]], wanted: list[str] | None = None
) -> list[tuple[str, int, int, str]]:
    """Rows (category, category order, keyword order, keyword); unknown names fail."""
    for name in wanted or []:
        if not categories.get(name):
            raise ValueError(f"Unknown category '{name}'. Choose from: {list(categories)}")
    return [
        (cat, c, k, word)
        for c, (cat, words) in enumerate(categories.items())
        if wanted is None or cat in wanted
        for k, word in enumerate(words)
    ]


def keyword_literals(rows: list[tuple[str, int, int, str]]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(cat).alias("category"),
                F.lit(k).alias("kw_ord"),
                F.lit(word).alias("keyword"),
            )
            for cat, _, k, word in rows
        ]
    )


def matching_keywords(
    models: DataFrame, categories: dict[str, list[str]], wanted: list[str] | None = None
) -> DataFrame:
    """One row per (model, matching keyword): a filter over a literal, no join."""
    ident = F.lower("model_id")
    hits = F.filter(
        keyword_literals(category_keywords(categories, wanted)),
        lambda k: F.contains(ident, F.lower(k["keyword"])),
    )
    # The outer form keeps the optimizer from testing the array's size first,
    # which would evaluate the whole filter twice.
    return (
        models.filter(F.col("task") == K.TASK)
        .select(F.explode_outer(hits).alias("hit"), "*")
        .filter(F.col("hit").isNotNull())
        .select("hit.category", "hit.kw_ord", "hit.keyword", *models.columns)
    )


def keyword_coverage(
    models: DataFrame, categories: dict[str, list[str]]
) -> DataFrame:
    """The category dimension with the number of registry rows each keyword finds."""
    rows = category_keywords(categories)
    found = (
        matching_keywords(models.select("model_id", "task"), categories)
        .groupBy("category", "kw_ord")
        .agg(F.count("*").alias("n"))
    )
    dim = models.sparkSession.createDataFrame(
        [(cat, k, word) for cat, _, k, word in rows],
        "category string, kw_ord int, keyword string",
    )
    return dim.join(found, ["category", "kw_ord"], "left").select(
        "category", "kw_ord", "keyword", F.coalesce("n", F.lit(0)).alias("n_models")
    )


def search_by_keyword(
    models: DataFrame,
    categories: dict[str, list[str]],
    wanted: list[str] | None = None,
    per_keyword: int = K.PER_KEYWORD,
) -> DataFrame:
    """Top rows by downloads for each keyword.

    The rank filter lets Spark cut every map task to ``per_keyword`` rows before
    the shuffle, so a keyword that hits a third of the registry stays cheap.
    """
    order = W.partitionBy("category", "kw_ord").orderBy(
        F.coalesce("downloads", F.lit(0)).desc(), "model_id"
    )
    return (
        matching_keywords(models, categories, wanted)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= per_keyword)
    )


def first_seen(hits: DataFrame) -> DataFrame:
    """One row per (category, model): the earliest keyword, then the best rank."""
    payload = [c for c in hits.columns if c not in ("category", "model_id", "kw_ord", "rank")]
    return (
        hits.groupBy("category", "model_id")
        .agg(F.min(F.struct("kw_ord", "rank", *payload)).alias("first"))
        .select("category", "model_id", "first.*")
    )


def quality_gate(hits: DataFrame, min_downloads=K.MIN_DOWNLOADS, min_likes=K.MIN_LIKES) -> DataFrame:
    return (
        hits.withColumn("downloads", F.coalesce("downloads", F.lit(0)))
        .withColumn("likes", F.coalesce("likes", F.lit(0)))
        .filter((F.col("downloads") >= min_downloads) & (F.col("likes") >= min_likes))
    )


def size_from_tags(tags: Column) -> Column:
    """First parsable size over tags x suffixes; greedy match = last occurrence."""
    per_tag = F.transform(
        F.coalesce(tags, F.array().cast("array<string>")),
        lambda tag: F.array(
            *[
                parse_float(
                    F.substring_index(
                        F.nullif(
                            F.regexp_extract(F.lower(tag), f"(?s)^(.+){suffix}", 1), F.lit("")
                        ),
                        "-",
                        -1,
                    )
                )
                for suffix in K.SIZE_SUFFIXES
            ]
        ),
    )
    return F.get(F.filter(F.flatten(per_tag), lambda v: v.isNotNull()), 0)


def size_from_id(model_id: Column) -> Column:
    """First token ending in ``b`` whose prefix parses; ``/`` does not split."""
    tokens = F.split(F.regexp_replace(F.lower(model_id), "[-_]", " "), r"(?U)\s+")
    sizes = F.transform(
        F.filter(tokens, lambda t: t.endswith("b")),
        lambda t: parse_float(F.left(t, F.length(t) - 1)),
    )
    return F.get(F.filter(sizes, lambda v: v.isNotNull()), 0)


def with_params(hits: DataFrame) -> DataFrame:
    """Model size in billions from tags, else from the id, else 0 (unknown)."""
    return hits.withColumn(
        "params_b",
        F.coalesce(size_from_tags(F.col("tags")), size_from_id(F.col("model_id")), F.lit(0.0)),
    )


def size_gate(hits: DataFrame, max_params_b: float = K.MAX_PARAMS_B) -> DataFrame:
    """Drop what is known to be too large; Spark ranks NaN above all, so keep it."""
    p = F.col("params_b")
    return hits.filter(F.isnan(p) | (p <= max_params_b))


def as_candidates(hits: DataFrame) -> DataFrame:
    return hits.select(
        "category",
        "model_id",
        "downloads",
        "likes",
        "params_b",
        F.coalesce(F.nullif("pipeline_tag", F.lit("")), F.lit(K.TASK)).alias("pipeline_tag"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        "kw_ord",
        "rank",
    )


def scan_registry(
    models: DataFrame,
    categories: dict[str, list[str]] = K.MODEL_CATEGORIES,
    wanted: list[str] | None = None,
    per_keyword: int = K.PER_KEYWORD,
    max_params_b: float = K.MAX_PARAMS_B,
) -> DataFrame:
    hits = first_seen(search_by_keyword(models, categories, wanted, per_keyword))
    return as_candidates(size_gate(with_params(quality_gate(hits)), max_params_b))


def card_completeness(cards: DataFrame) -> DataFrame:
    """Share of the expected headings found in each card."""
    lowered = cards.select("model_id", F.lower("card_text").alias("text"))
    found = sum(
        F.coalesce(F.contains("text", F.lit(h.lower())).cast("int"), F.lit(0))
        for h in K.CARD_HEADINGS
    )
    return lowered.select(
        "model_id", (found / F.lit(len(K.CARD_HEADINGS))).cast("double").alias("card_quality")
    )


def with_card_quality(candidates: DataFrame, cards: DataFrame) -> DataFrame:
    """Attach card completeness; a missing card counts as 0.

    Only cards of candidates are searched; their number is bounded by the keyword cut.
    Pass a written table of candidates, as it is read twice.
    """
    wanted = cards.join(candidates.select("model_id").distinct(), "model_id", "left_semi")
    return candidates.join(card_completeness(wanted), "model_id", "left").withColumn(
        "card_quality", F.coalesce("card_quality", F.lit(0.0))
    )


def composite_score() -> Column:
    dl = F.log10(F.greatest(F.col("downloads"), F.lit(1)).cast("double")) / 8
    likes = F.log10(F.greatest(F.col("likes"), F.lit(1)).cast("double")) / 5
    p = F.col("params_b")
    fit = (
        F.when(p == 0.0, F.lit(0.3))
        .when(F.isnan(p), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), 1 - F.abs(p - 7.0) / 7.0))
    )
    return 0.4 * dl + 0.2 * likes + 0.2 * F.col("card_quality") + 0.2 * fit


def scored(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn("score", composite_score()).withColumn("notes", F.lit(""))


def perplexity(probe_losses: DataFrame, n_probes: int = len(K.PROBE_TEXTS)) -> DataFrame:
    """Mean exp(loss) per model; null when a probe failed or is missing."""
    return (
        probe_losses.groupBy("model_id")
        .agg(
            F.count("loss").alias("ok"),
            F.count("*").alias("n"),
            F.avg(F.exp("loss")).alias("mean"),
        )
        .select(
            "model_id",
            F.when((F.col("ok") == n_probes) & (F.col("n") == n_probes), F.col("mean")).alias("ppl"),
        )
    )


def _ranked(candidates: DataFrame) -> DataFrame:
    order = W.partitionBy("category").orderBy(F.col("score").desc(), "kw_ord", "rank")
    return candidates.withColumn("place", F.row_number().over(order))


def probes_of_leading(candidates: DataFrame, probe_losses: DataFrame, top_k: int = K.TOP_K) -> DataFrame:
    """Losses of the 2 x top_k leading models of each category, the only ones blended."""
    leading = _ranked(candidates).filter(F.col("place") <= 2 * top_k).select("model_id").distinct()
    return probe_losses.join(leading, "model_id", "left_semi")


def blend_perplexity(candidates: DataFrame, ppl: DataFrame, top_k: int = K.TOP_K) -> DataFrame:
    """Re-score the leading 2 x top_k of each category where a perplexity is known."""
    bonus = F.when(F.isnan("ppl"), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), 1 - (F.col("ppl") - 5) / 100)
    )
    probed = (F.col("place") <= 2 * top_k) & F.col("ppl").isNotNull()
    return (
        _ranked(candidates)
        .join(ppl, "model_id", "left")
        .withColumn(
            "score", F.when(probed, 0.7 * F.col("score") + 0.3 * bonus).otherwise(F.col("score"))
        )
        .withColumn(
            "notes",
            F.when(probed, F.concat(F.lit("ppl="), fixed(F.col("ppl"), 1))).otherwise(F.col("notes")),
        )
        .drop("place", "ppl")
    )


def top_candidates(candidates: DataFrame, top_k: int = K.TOP_K) -> DataFrame:
    return _ranked(candidates).filter(F.col("place") <= top_k)


def discover(
    models: DataFrame,
    cards: DataFrame,
    probe_losses: DataFrame | None = None,
    categories: dict[str, list[str]] = K.MODEL_CATEGORIES,
    wanted: list[str] | None = None,
    top_k: int = K.TOP_K,
    per_keyword: int = K.PER_KEYWORD,
) -> DataFrame:
    """Scan, gate, score and cut: every requested category in one job."""
    found = settled(scan_registry(models, categories, wanted, per_keyword))
    candidates = scored(with_card_quality(found, cards))
    if probe_losses is not None:
        candidates = settled(candidates)
        probes = probes_of_leading(candidates, probe_losses, top_k)
        candidates = blend_perplexity(candidates, perplexity(probes), top_k)
    return top_candidates(candidates, top_k)


def ranked_report(ranked: DataFrame) -> DataFrame:
    """Display rows of a ranked shortlist."""
    p = F.col("params_b")
    return ranked.select(
        "category",
        F.col("place").alias("rank"),
        "model_id",
        F.when(p == 0.0, F.lit("?")).otherwise(fixed(p, 1)).alias("params"),
        grouped(F.col("downloads")).alias("downloads"),
        F.col("likes").cast("string").alias("likes"),
        fixed(F.col("card_quality"), 2).alias("card"),
        fixed(F.col("score"), 3).alias("score"),
        "notes",
    )
