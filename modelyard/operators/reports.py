"""Workload figures, run records, cards and the leaderboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.functions.numbers import fixed
from modelyard.functions.text import fill


def workload_prompts() -> Column:
    """The fixed request prompts as an array, topics in turn."""
    topics = K.WORKLOAD_TOPICS * K.WORKLOAD_REPEATS
    return F.array(*[F.lit(f"Explain the concept of {t} in detail.") for t in topics])


def workload(sizes: DataFrame, n_requests: str = "n_requests") -> DataFrame:
    """First ``n_requests`` prompts per row; the fixed list ends at fifty."""
    n = F.least(F.col(n_requests), F.lit(K.WORKLOAD_REQUESTS)).cast("int")
    return sizes.select(
        "model_id", F.posexplode(F.slice(workload_prompts(), F.lit(1), n)).alias("pos", "prompt")
    )


def request_latency(responses: DataFrame) -> DataFrame:
    """Elapsed time of the batch shared evenly by its outputs."""
    per_batch = responses.groupBy("model_id", "batch_id").agg(
        (F.sum("elapsed_ms") / F.count("*")).alias("latency_ms")
    )
    return responses.join(per_batch, ["model_id", "batch_id"]).select(
        "model_id", "batch_id", "turn", "tokens_used", "latency_ms"
    )


def throughput(responses: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """Totals per model, rounded half-even on the binary value.

    The latency is per request asked for, ``requested (model_id, requested)``, also where
    the fixed workload holds fewer; without it, per answer.
    """

    def rounded(value: Column, places: int) -> Column:
        return fixed(value, places).cast("double")

    ms = F.col("ms")
    totals = responses.groupBy("model_id").agg(
        F.count("*").alias("answers"),
        F.sum("tokens_used").alias("total_tokens"),
        F.sum("elapsed_ms").cast("double").alias("ms"),
    )
    if requested is not None:
        totals = totals.join(requested.select("model_id", "requested"), "model_id", "left")
    asked = F.col("requested") if requested is not None else F.lit(None)
    return (
        totals.withColumn("n_requests", F.coalesce(asked.cast("bigint"), "answers"))
        .select(
            "model_id",
            "n_requests",
            "total_tokens",
            rounded(ms / 1000, 2).alias("elapsed_s"),
            rounded(F.try_divide(F.col("total_tokens"), ms / 1000), 1).alias("tokens_per_sec"),
            rounded(ms / F.col("n_requests"), 1).alias("avg_latency_ms"),
        )
    )


_METRICS = [c for c, _, _ in K.RUN_METRICS]


def run_records(
    summary: DataFrame,
    run_name: Column,
    strategy: Column | None = None,
    base_models: Column | None = None,
    notes: Column | None = None,
) -> DataFrame:
    """One wide row per evaluated model; fields that were not measured default."""
    none = F.array().cast("array<string>")
    have = set(summary.columns)
    return summary.select(
        run_name.alias("run_name"),
        "model_id",
        F.coalesce(strategy if strategy is not None else F.lit(None), F.lit("")).alias("merge_strategy"),
        F.coalesce(base_models if base_models is not None else F.lit(None), none).alias("base_models"),
        *[
            F.coalesce(F.col(c).cast("double") if c in have else F.lit(None), F.lit(0.0)).alias(c)
            for c in _METRICS
        ],
        F.coalesce(F.col("gap_categories") if "gap_categories" in have else F.lit(None), none).alias(
            "gap_categories"
        ),
        F.coalesce(notes if notes is not None else F.lit(None), F.lit("")).alias("notes"),
    )


def run_metrics(runs: DataFrame) -> DataFrame:
    """Metric rows under both naming schemes."""
    cells = F.array(
        *[
            F.struct(F.lit(long).alias("tracker_name"), F.lit(bare).alias("bare_name"), F.col(c).alias("value"))
            for c, long, bare in K.RUN_METRICS
        ]
    )
    return runs.select("run_name", "model_id", F.inline(cells))


# Sections, table rows and number formats of a card.
_CARD = """---
language:
- en
tags:
- merged-model
- peft
license: apache-2.0
pipeline_tag: text-generation
---

# {model_name}

## Model Details

| Property       | Value |
|----------------|-------|
| Base models    | {base_models} |
| Merge strategy | `{merge_strategy}` |
| Fine-tuning    | {tuning} |
| Scale          | {scale} |
| Precision      | {precision} |

## Evaluation Results

| Metric             | Score |
|--------------------|-------|
| ROUGE-1            | {rouge1} |
| ROUGE-2            | {rouge2} |
| ROUGE-L            | {rougeL} |
| BERTScore F1       | {bertscore} |
| Faithfulness       | {faithfulness} |
| Hallucination rate | {hallucination} |
| Judge Score        | {judge}/10 |

## Training Details

### Knowledge Gaps Addressed
{gaps}

### Merge Configuration
- **Strategy**: {merge_strategy}
- **Density** (TIES/Breadcrumbs): {density}
- **Alpha**: {alpha}

## Usage

Weights and tokenizer are stored under `{repo_id}`. Prompts of the evaluation have the form

    Context: (passage)
    Question: (question)
    Answer:

## Limitations
- The scores hold for the questions of the evaluation; nothing else was measured.
- {hallucination} of its answers were marked as not supported by their context.
"""
#: What a card says of the run beside its scores.
CARD_SETTINGS = {
    "tuning": "none",
    "scale": "not stated",
    "precision": "bfloat16",
    "density": str(K.DENSITY),
    "alpha": str(K.SCALING),
}


def model_cards(runs: DataFrame, repo_id: Column, **settings: str) -> DataFrame:
    """Markdown card per run; ``settings`` replace entries of CARD_SETTINGS."""
    stated = CARD_SETTINGS | settings
    gaps = F.array_join(F.transform("gap_categories", lambda g: F.concat(F.lit("- "), g)), "\n")
    card = fill(
        _CARD,
        model_name=F.substring_index(repo_id, "/", -1),
        base_models=F.array_join(
            F.transform("base_models", lambda m: F.concat(F.lit("`"), m, F.lit("`"))), ", "
        ),
        merge_strategy=F.col("merge_strategy"),
        rouge1=fixed(F.col("avg_rouge1"), 3),
        rouge2=fixed(F.col("avg_rouge2"), 3),
        rougeL=fixed(F.col("avg_rougeL"), 3),
        bertscore=fixed(F.col("avg_bertscore"), 3),
        faithfulness=fixed(F.col("avg_faithfulness"), 3),
        hallucination=F.concat(fixed(F.col("hallucination_rate") * 100, 1), F.lit("%")),
        judge=fixed(F.col("avg_judge_score"), 1),
        gaps=F.coalesce(F.nullif(gaps, F.lit("")), F.lit("- None detected")),
        repo_id=repo_id,
        **{name: F.lit(stated[name]) for name in CARD_SETTINGS},
    )
    return runs.select("run_name", "model_id", card.alias("card"))


def result_file(model_id: Column, dataset: Column) -> Column:
    """Name under which an evaluation is saved."""
    return F.concat(
        F.lit("eval_"), F.replace(model_id, F.lit("/"), F.lit("_")), F.lit("_"), dataset, F.lit(".json")
    )


def leaderboard(results: DataFrame, top_n: int = K.LEADERBOARD_ROWS) -> DataFrame:
    """Best runs by the first overlap score; ties in order of the result's file name."""

    def metric(name: str) -> Column:
        known = F.col(name) if name in results.columns else F.lit(None)
        return F.coalesce(known.cast("double"), F.lit(0.0))

    order = [F.col("_score").desc(), F.col("_file"), F.col("model_id")]
    top = (
        results.withColumn("_file", result_file(F.col("model_id"), F.col("dataset")))
        .withColumn("_score", metric("avg_rouge1"))
        .orderBy(*order)
        .limit(top_n)
    )
    place = W.orderBy(*order)  # at most top_n rows
    return top.select(
        F.row_number().over(place).alias("rank"),
        F.right(F.coalesce("model_id", F.lit("")), F.lit(K.LEADERBOARD_ID_CHARS)).alias("model"),
        F.coalesce("dataset", F.lit("")).alias("dataset"),
        fixed(F.col("_score"), 3).alias("rouge1"),
        fixed(metric("avg_bertscore"), 3).alias("bertscore"),
        fixed(metric("avg_faithfulness"), 3).alias("faithfulness"),
        fixed(metric("avg_judge_score"), 1).alias("judge"),
        F.concat(fixed(metric("hallucination_rate") * 100, 1), F.lit("%")).alias("hallucination"),
    )
