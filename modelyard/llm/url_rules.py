"""URL verdicts from written rules and mined token rules, in DataFrame operations only.

Written rules (host and path prefix) decide first. For the other URLs, Spark's FP-growth
mines combinations of URL tokens that imply a block label; rules that are too rare, not
confident enough or implied by a shorter rule are pruned, and the rest are matched through
an inverted index (each rule is filed under its rarest token).

Defined results: a null URL or one without "://" has an empty host and path, no rule, and
is allowed. Repeated rows and repeated URLs get the same verdict. Without labels no rule
is mined and every undecided URL is allowed. Extra columns pass through; columns of the
result's names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.llm.text import free_name

BLOCK = "label=block"
MIN_SUPPORT = 0.002  # share of labelled URLs that hold the tokens and are blocked
MIN_COUNT = 10
MIN_CONFIDENCE = 0.6
ADDED = ("host", "path", "rule", "verdict")


@dataclass(frozen=True)
class UrlRule:
    """A rule such as ("allow", "example.org/es/"): a host, then a path prefix."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        host, slash, rest = self.text.partition("/")
        return slash + rest


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, ASCII letters lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def written_rule(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """Struct of the longest written rule that fits (text, verdict), or null."""
    fits = []
    for r in sorted(rules, key=lambda r: (-len(r.host), -len(r.path), r.text)):
        own_host = (host == r.host) | F.endswith(host, F.lit("." + r.host))
        match = F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))
        fits.append(F.when(own_host & F.startswith(path, F.lit(r.path)), match))
    none = F.lit(None).cast("struct<text:string,verdict:string>")
    return F.coalesce(*fits, none)


def tokens(url: Column) -> Column:
    """Distinct URL tokens: scheme, host parts, path segments with digits folded, query keys."""
    host, path = host_of(url), path_of(url)
    prefixed = lambda kind, values: F.transform(
        F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x)
    )
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    found = F.concat(
        prefixed("scheme:", F.array(F.regexp_extract(F.coalesce(url, F.lit("")), "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))),
        prefixed("host:", F.split(host, r"\.")),
        prefixed("path:", F.split(F.regexp_replace(path, "[0-9]+", "0"), "/")),
        prefixed("key:", F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))),
    )
    return F.array_distinct(found)


def mine(
    labelled: DataFrame,
    url: str = "url",
    blocked: str = "blocked",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules (antecedent, confidence, support, lift) that imply a block label.

    Their number is bounded by the support, not by the table: an itemset must occur in a
    fixed share of the labelled URLs. A rule is dropped if a rule on fewer of its tokens is
    at least as confident.
    """
    baskets = labelled.filter(F.col(url).isNotNull() & F.col(blocked).isNotNull()).select(
        F.when(F.col(blocked), F.array_append(tokens(F.col(url)), F.lit(BLOCK)))
        .otherwise(tokens(F.col(url)))
        .alias("items")
    )
    total = baskets.count()
    if total == 0:
        return labelled.sparkSession.createDataFrame(
            [], "antecedent array<string>, confidence double, lift double, support double"
        )
    support = max(min_support, min(1.0, MIN_COUNT / total))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.filter(
        (F.size("consequent") == 1)
        & (F.col("consequent")[0] == BLOCK)
        & (F.col("lift") > 1)
    ).select(F.array_sort("antecedent").alias("antecedent"), "confidence", "lift", "support")
    shorter = rules.select(
        F.explode("antecedent").alias("token"),
        F.col("antecedent").alias("inner"),
        F.col("confidence").alias("inner_confidence"),
    )
    # a shorter rule shares its first token with every longer rule that holds it
    shorter = shorter.filter(F.col("token") == F.col("inner")[0])
    implied = (
        rules.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
        .join(shorter, "token")
        .filter(
            (F.size("inner") < F.size("antecedent"))
            & (F.size(F.array_except("inner", "antecedent")) == 0)
            & (F.col("inner_confidence") >= F.col("confidence"))
        )
        .select("antecedent")
        .distinct()
    )
    return rules.join(implied, "antecedent", "left_anti")


def matches(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Distinct URLs that some mined rule fits, with the best confidence, by inverted index."""
    sized = urls.select(url).filter(F.col(url).isNotNull()).distinct()
    split = sized.select(url, tokens(F.col(url)).alias("url_tokens"))
    index = rules.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
    wanted = index.select("token").distinct()
    posted = split.select(url, "url_tokens", F.explode("url_tokens").alias("token")).join(
        wanted, "token", "left_semi"
    )
    counts = posted.groupBy("token").agg(F.count("*").alias("n"))
    filed = (
        index.join(counts, "token")  # a rule with a token that no URL has cannot match
        .groupBy("antecedent", "confidence")
        .agg(F.min(F.struct("n", "token")).alias("key"))
        .select("antecedent", "confidence", F.col("key.token").alias("token"))
    )
    return (
        posted.join(filed, "token")
        .filter(F.size(F.array_except("antecedent", "url_tokens")) == 0)
        .groupBy(url)
        .agg(F.max("confidence").alias("confidence"))
    )


def judge(pages: DataFrame, rules: list[UrlRule], mined: DataFrame, url: str = "url") -> DataFrame:
    """pages with host, path, rule and verdict (allow or block)."""
    found = matches(pages, mined, url)
    key, hit = free_name(pages, "matched_url"), free_name(pages, "matched_confidence")
    found = found.select(F.col(url).alias(key), F.col("confidence").alias(hit))
    marked = pages.join(found, pages[url] == found[key], "left")
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule = written_rule(host, path, rules)
    values = {
        "host": host,
        "path": path,
        "rule": rule["text"],
        "verdict": F.coalesce(
            rule["verdict"], F.when(F.col(hit).isNotNull(), "block").otherwise("allow")
        ),
    }
    rest = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ADDED]
    return marked.select(*rest, *[v.alias(k) for k, v in values.items()])


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """URLs with blocked = the document of the page is labelled toxic or of low quality."""
    return (
        pages.select(F.col("page_id").alias("doc_id"), "url")
        .join(labels.select("doc_id", "quality", "toxic"), "doc_id")
        .select("url", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    )
