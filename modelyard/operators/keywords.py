"""Keywords inside texts, for keyword tables of any size: an n-gram inverted index.

A keyword is filed under one of its n-grams, the one that fewest keywords have. The n-grams
of a text meet the index in one join; a pair that meets is a candidate and is verified with
`contains`. The plan does not grow with the keywords, and a text meets the keywords that
share a rare n-gram with it instead of all of them. Case is ignored. An empty keyword is in
every text, a null one in none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.operators.evaluation import is_failing

GRAM = 3  # characters; a shorter keyword is filed under itself
NEAR = 10_000  # keywords of a table that is sent to the texts, below 1 MB


def _ngrams(text: Column, sizes: Column) -> Column:
    """Distinct runs of that many characters; linear in the text, which is split once."""

    def runs(letters: Column) -> Column:
        def of(n: Column) -> Column:
            last = F.size(letters) - n + 1
            starts = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1))))
            return F.transform(
                F.coalesce(starts, F.array().cast("array<int>")),
                lambda i: F.concat(
                    *[F.when(n > k, F.get(letters, i - 1 + k)).otherwise("") for k in range(GRAM)]
                ),
            )

        return F.array_distinct(F.flatten(F.transform(sizes, of)))

    # a lambda's variable, so that the split is not repeated for every position
    return F.transform(F.array(F.split(text, "")), runs)[0]


def text_ngrams(text: Column) -> Column:
    """All keys under which a keyword inside the text may be filed."""
    every = _ngrams(text, F.array(*[F.lit(n) for n in range(1, GRAM + 1)]))
    return F.concat(F.array(F.lit("")), F.filter(every, lambda g: g != ""))


def index(keywords: DataFrame, keyword: str = "keyword") -> DataFrame:
    """keywords with ``gram``, the key each is filed under."""
    word = F.lower(keyword)
    words = keywords.select(word.alias("word")).filter(F.col("word").isNotNull()).distinct()
    size = F.array(F.least(F.length("word"), F.lit(GRAM)))
    grams = F.when(F.col("word") == "", F.array(F.lit(""))).otherwise(_ngrams(F.col("word"), size))
    filed = words.select("word", F.explode(grams).alias("gram"))
    shared = filed.groupBy("gram").agg(F.count("*").alias("n"))
    best = (
        filed.join(shared, "gram")
        .groupBy("word")
        .agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    )
    return keywords.withColumn("word", word).join(best, "word").drop("word")


def matches(
    texts: DataFrame, key: list[str], text: str, keywords: DataFrame, keyword: str = "keyword", carried: bool = False
) -> DataFrame:
    """Rows (key columns, columns of keywords): every keyword that the text contains.

    Grams travel with the key alone and candidates fetch their text afterwards; ``carried``
    lets a short text travel with its grams instead. The key tells texts apart.
    """
    body = F.lower(text)
    grams = texts.select(
        *key, *([body.alias("_text")] if carried else []), F.explode(text_ngrams(body)).alias("gram")
    )
    # Spark takes the grams for as small as the texts and would broadcast them
    found = grams.hint("merge").join(index(keywords, keyword), "gram").drop("gram")
    if not carried:
        found = found.join(texts.select(*key, body.alias("_text")), key)
    return found.filter(F.contains("_text", F.lower(keyword))).drop("_text")


def touched(texts: DataFrame, key: list[str], text: str, keywords: DataFrame, names: list[str], near: int = NEAR) -> DataFrame:
    """Distinct rows (key columns, ``names`` of keywords) of texts and the keywords they contain.

    A table of at most ``near`` keywords is sent to the texts, one row per ``names``, and a text
    is read until a keyword of that row is met. Beyond that grams travel, as in ``matches``.
    """
    if keywords.limit(near + 1).count() > near:
        return matches(texts, key, text, keywords).select(*key, *names).distinct()
    lists = keywords.groupBy(*names).agg(F.collect_set(F.lower("keyword")).alias("_words"))
    bodies = texts.select(*key, F.lower(text).alias("_text"))
    met = bodies.crossJoin(F.broadcast(lists)).filter(F.exists("_words", lambda w: F.contains("_text", w)))
    return met.select(*key, *names).distinct()


def search(models: DataFrame, keywords: DataFrame, per_keyword: int = K.PER_KEYWORD) -> DataFrame:
    """Top rows by downloads for each row (category, kw_ord, keyword) of a keyword table.

    Equal to ``discovery.search_by_keyword``, which spells its few keywords out in the plan.
    """
    wanted = models.filter(F.col("task") == K.TASK)
    hits = matches(wanted.select("model_id", "downloads"), ["model_id", "downloads"], "model_id", keywords, carried=True)
    order = W.partitionBy("category", "kw_ord", "keyword").orderBy(F.coalesce("downloads", F.lit(0)).desc(), "model_id")
    best = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_keyword)
    return best.drop("downloads").join(wanted, "model_id")


def gap_categories(
    scores: DataFrame, samples: DataFrame, keywords: DataFrame, least: int = K.GAP_MIN_FAILURES
) -> DataFrame:
    """Categories of a keyword table that failing answers touch, per model.

    Rows (model_id, cat_ord, gap_cat, failures, first_ord); a category counts once per
    answer however many of its keywords occur. keywords: (cat_ord, gap_cat, keyword).
    """
    key = ["model_id", "sample_id"]
    failing = scores.filter(is_failing()).select(*key, "ord")
    body = F.concat(F.coalesce("question", F.lit("")), F.lit(" "), F.coalesce("context", F.lit("")))
    texts = samples.select(*key, body.alias("body")).join(failing, key)
    return (
        touched(texts, [*key, "ord"], "body", keywords, ["cat_ord", "gap_cat"])
        .groupBy("model_id", "cat_ord", "gap_cat")
        .agg(F.count("*").alias("failures"), F.min("ord").alias("first_ord"))
        .filter(F.col("failures") >= least)
    )
