"""Score rows, weak categories and summaries over whole evaluations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.functions.numbers import fixed
from modelyard.operators import scoring as S
from modelyard.operators.replies import remembered_call

KEY = S.KEY
MEANS = {
    "avg_rouge1": "rouge1",
    "avg_rouge2": "rouge2",
    "avg_rougeL": "rougeL",
    "avg_bertscore": "bertscore_f1",
    "avg_faithfulness": "faithfulness",
    "hallucination_rate": "hallucinated",
    "avg_judge_score": "judge_score",
}


def with_gap_bits(samples: DataFrame) -> DataFrame:
    """Bit i is set when a keyword of category i occurs in question or context.

    Keywords match as substrings. The text is lowered in a projection of its own
    so that it is lowered once, not once per keyword.
    """
    text = F.lower(
        F.concat(F.coalesce("question", F.lit("")), F.lit(" "), F.coalesce("context", F.lit("")))
    )
    bits = [
        F.when(
            reduce(lambda a, b: a | b, [F.contains("_text", F.lit(w)) for w in words]), 2**i
        ).otherwise(0)
        for i, words in enumerate(K.GAP_KEYWORDS.values())
    ]
    return (
        samples.withColumn("_text", text)
        .withColumn("gap_bits", reduce(lambda a, b: a + b, bits))
        .drop("_text")
    )


def sample_scores(
    samples: DataFrame,
    embedding_scores: DataFrame | None = None,
    run_judge: bool = True,
    stem: bool = True,
) -> DataFrame:
    """One score row per answer, decided inside the row: one scan, no shuffle.

    ``embedding_scores`` holds (model_id, sample_id, bertscore_f1) and is joined by
    answer; an answer missing from it scores 0. ``gap_signals`` exists and stays
    empty.
    """
    faith = S.faithfulness(F.col("nli_label"), F.col("nli_score"))
    judged = S.judge_score(F.col("judge_raw")) if run_judge else F.lit(K.DEFAULT_JUDGE)
    local = with_gap_bits(samples).select(
        *KEY,
        "ord",
        "prediction",
        "reference",
        faith.alias("faithfulness"),
        S.hallucinated(F.col("prediction"), faith).alias("hallucinated"),
        judged.alias("judge_score"),
        "gap_bits",
    )
    rows = S.rouge(local, stem, "ord", "faithfulness", "hallucinated", "judge_score", "gap_bits")
    if embedding_scores is not None:
        rows = rows.join(embedding_scores, KEY, "left")
    else:
        rows = rows.withColumn("bertscore_f1", F.lit(0.0))
    return rows.select(
        *KEY,
        "ord",
        "rouge1",
        "rouge2",
        "rougeL",
        F.coalesce("bertscore_f1", F.lit(0.0)).alias("bertscore_f1"),
        "faithfulness",
        "hallucinated",
        "judge_score",
        "gap_bits",
        F.array().cast("array<string>").alias("gap_signals"),
    )


def is_failing() -> Column:
    t = K.GAP_THRESHOLDS
    return (
        (F.col("rouge1") < t["rouge"])
        | (F.col("bertscore_f1") < t["bertscore"])
        | (F.col("faithfulness") < t["faithfulness"])
        | (F.col("judge_score") < t["judge"])
        | F.col("hallucinated")
    )


def failing(scores: DataFrame) -> DataFrame:
    return scores.filter(is_failing())


def _gap_counts() -> list[Column]:
    """Per category: failing answers that touch it, and the first of them."""
    out = []
    for i in range(len(K.GAP_KEYWORDS)):
        hit = is_failing() & (F.col("gap_bits").bitwiseAND(2**i) != 0)
        out += [F.count_if(hit).alias(f"_n{i}"), F.min(F.when(hit, F.col("ord"))).alias(f"_f{i}")]
    return out


def _gap_rows() -> Column:
    """Categories with enough failures, in order of first occurrence."""
    rows = F.array(
        *[
            F.struct(
                F.col(f"_f{i}").alias("first_ord"),
                F.lit(i).alias("cat_ord"),
                F.lit(cat).alias("gap_cat"),
                F.col(f"_n{i}").alias("failures"),
            )
            for i, cat in enumerate(K.GAP_KEYWORDS)
        ]
    )
    return F.sort_array(F.filter(rows, lambda r: r["failures"] >= K.GAP_MIN_FAILURES))


def detect_gaps(scores: DataFrame, by: tuple[str, ...] = ("model_id",)) -> DataFrame:
    """Categories with at least two failures per group.

    Five pairs of conditional aggregates in one pass that combines map-side: a
    group of any size sends one row per task.
    """
    return scores.groupBy(*by).agg(*_gap_counts()).select(*by, F.inline(_gap_rows()))


def summarise(scores: DataFrame, dataset: str = "custom") -> DataFrame:
    """Means, counts and gap categories per model in one aggregation.

    Score rows stay a table of their own, keyed the same way, instead of a list
    nested in the summary, which one task would have to hold.
    """
    means = [
        F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0)).alias(name)
        for name, c in MEANS.items()
    ]
    return (
        scores.groupBy("model_id")
        .agg(F.count("*").alias("n_samples"), *means, *_gap_counts())
        .select(
            "model_id",
            F.lit(dataset).alias("dataset"),
            "n_samples",
            *MEANS,
            F.transform(_gap_rows(), lambda r: r["gap_cat"]).alias("gap_categories"),
        )
    )


def _long(summary: DataFrame, metrics: dict[str, str], *keep: str) -> DataFrame:
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("metric_ord"), F.lit(label).alias("metric"), F.col(c).alias("value"))
            for i, (label, c) in enumerate(metrics.items())
        ]
    )
    return summary.select(*keep, F.inline(cells))


def compare_models(summary: DataFrame, models: list[str]) -> DataFrame:
    """Metric rows with one column per model; naming the models avoids a scan."""
    return (
        _long(summary, K.COMPARED, "model_id")
        .groupBy("metric_ord", "metric")
        .pivot("model_id", models)
        .agg(F.first("value"))
    )


def threshold_table(summary: DataFrame) -> DataFrame:
    """Seven display rows per model: metric, score text, threshold text."""
    t = K.GAP_THRESHOLDS
    limits = {
        "ROUGE-1": f"{t['rouge']:.2f}",
        "BERTScore F1": f"{t['bertscore']:.2f}",
        "Faithfulness": f"{t['faithfulness']:.2f}",
        "Hallucination %": "< 10%",
        "Judge Score": f"{t['judge']:.0f}/10",
    }
    threshold = F.lit("—")
    for label, limit in limits.items():
        threshold = F.when(F.col("metric") == label, limit).otherwise(threshold)
    value = F.col("value")
    score = (
        F.when(F.col("metric") == "Hallucination %", F.concat(fixed(value * 100, 1), F.lit("%")))
        .when(F.col("metric") == "Judge Score", F.concat(fixed(value, 1), F.lit("/10")))
        .otherwise(fixed(value, 3))
    )
    return _long(summary, K.SHOWN, "model_id").select(
        "model_id", "metric_ord", "metric", score.alias("score"), threshold.alias("threshold")
    )


def evaluate(
    samples: DataFrame,
    generate: S.Model,
    classify: S.Model,
    judge: S.Model | None = None,
    embedding_scores_of=None,
    dataset: str = "custom",
    batch_size: int = 4,
    stem: bool = True,
    replies_path: str | None = None,
    names: tuple[str, str, str] = ("generator", "classifier", "judge"),
) -> tuple[DataFrame, DataFrame]:
    """(summary, scores) of models over samples: generation, entailment, judge, scores.

    Each model argument is a factory as in ``batched_call``. ``classify`` replies
    ``LABEL score``. A failed call scores as neutral; without a judge every answer gets
    the default score. ``embedding_scores_of`` maps the answers to (model_id, sample_id,
    bertscore_f1). With ``replies_path`` replies are kept in that table under the model's
    name in ``names``: an evaluation that is run again, or was killed, asks for the rest only.
    """

    def ask(rows: DataFrame, output: str, model: S.Model, name: str) -> DataFrame:
        if replies_path is None:
            return S.batched_call(rows, "prompt", output, model, batch_size)
        return remembered_call(rows, "prompt", output, model, name, replies_path, batch_size)

    asked = samples.withColumn("prompt", S.qa_prompt())
    answers = ask(asked, "prediction", generate, names[0])
    answers = answers.withColumn("prediction", F.coalesce("prediction", F.lit("")))
    paired = answers.withColumn("prompt", S.nli_pair())
    labelled = ask(paired, "nli", classify, names[1])
    labelled = labelled.withColumns(
        {
            "nli_label": F.nullif(F.regexp_extract("nli", r"^(\S+)\s+\S+$", 1), F.lit("")),
            "nli_score": F.regexp_extract("nli", r"^\S+\s+(\S+)$", 1).try_cast("double"),
        }
    )
    if judge is None:
        judged = labelled.withColumn("judge_raw", F.lit(None).cast("string"))
    else:
        judged = ask(labelled.withColumn("prompt", S.judge_prompt()), "judge_raw", judge, names[2])
    done = judged.drop("prompt", "nli")
    embedding = embedding_scores_of(done) if embedding_scores_of else None
    scores = sample_scores(done, embedding, judge is not None, stem)
    return summarise(scores, dataset), scores
