"""One run from discovery to the run record, composed of the operators.

The only values brought to the driver are the ids of the shortlist (at most
``top_k``), which name the weights to merge. Score rows are written to the shared
folder once: gaps, prompts and the record read that table, so answers are scored
once and a lost executor costs no second evaluation. With a state folder every stage is
kept by a fingerprint of its inputs, and a run that was killed goes on after the last one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.operators import discovery as D
from modelyard.operators import evaluation as V
from modelyard.operators import merging as G
from modelyard.operators import reports as R
from modelyard.operators import synthetic as Y
from modelyard.plans.manifest import Manifest, digest, fingerprint
from modelyard.session import written
from modelyard.sources import files

MERGED_MODELS = 3


@dataclass
class RunResult:
    evaluated_model: str
    candidates: DataFrame | None = None
    merged: DataFrame | None = None
    scores: DataFrame | None = None
    gaps: DataFrame | None = None
    prompts: DataFrame | None = None
    training_rows: DataFrame | None = None
    record: DataFrame | None = None
    history: DataFrame | None = None
    leaderboard: DataFrame | None = None
    shortlist: list[str] = field(default_factory=list)


def full_run(
    category: str,
    models: DataFrame | None = None,
    cards: DataFrame | None = None,
    weights_of: Callable[[list[str]], DataFrame] | None = None,
    answers_of: Callable[[str], DataFrame] | None = None,
    replies_to: Callable[[DataFrame], DataFrame] | None = None,
    embedding_scores_of: Callable[[DataFrame], DataFrame] | None = None,
    categories: dict[str, list[str]] = K.MODEL_CATEGORIES,
    strategy: str = "ties",
    base_model: str = "base",
    top_k: int = K.TOP_K,
    skip_discover: bool = False,
    skip_merge: bool = False,
    skip_eval: bool = False,
    skip_training: bool = False,
    stem: bool = True,
    train: Callable[[str, DataFrame, int], str] | None = None,
    max_iterations: int = 3,
    results_path: str | None = None,
    log_path: str | None = None,
    state_path: str | None = None,
    inputs: str = "",
) -> RunResult:
    """Discover, merge the leading three, evaluate, target the gaps, record.

    The callables stand for what needs a model: ``weights_of`` gives the chunked
    weights of named models, ``answers_of`` the scored-question table with a
    model's answers, ``replies_to`` the generator's replies to gap prompts, ``train`` a
    model trained further on rows. With ``train`` the improvement loop runs instead of one
    pass over the gaps. ``results_path`` receives the evaluation and is read back as the
    leaderboard, ``log_path`` the run record.

    ``state_path`` keeps the stages; the same run started again reads those that are there.
    Registry and cards are told by their rows. What the callables read is not seen by the
    run, so ``inputs`` names it (versions of weights, questions, models).
    """
    shortlist: list[str] = []
    candidates = merged = None
    state = Manifest(SparkSession.active(), state_path) if state_path else None
    made = {"category": category, "strategy": strategy, "base": base_model, "inputs": inputs}

    def stage(name: str, build: Callable[[], DataFrame], **parts) -> DataFrame:
        """build() as a stage; its parts join those of all stages before."""
        made.update({f"{name}.{k}": v for k, v in parts.items()})
        return state.stage(name, digest(made), build, **made) if state else build()

    if not skip_discover:
        known = {"models": fingerprint(models), "cards": fingerprint(cards)} if state else {}
        candidates = stage(
            "candidates",
            lambda: D.discover(models, cards, None, categories, [category], top_k),
            categories=categories,
            top_k=top_k,
            **known,
        )
        shortlist = [r["model_id"] for r in candidates.orderBy("place").select("model_id").collect()]
        if not shortlist:
            raise RuntimeError("no candidates found")
    evaluated = base_model
    if not skip_merge and shortlist:
        chosen = shortlist[:MERGED_MODELS]
        evaluated = f"{strategy}_" + "_".join(m.split("/")[-1] for m in chosen[:2])
        merged = stage(
            "merged",
            lambda: G.merge_models(weights_of(chosen), strategy, chosen, base_model=chosen[0], name=evaluated),
            chosen=chosen,
        )
    run = RunResult(evaluated, candidates, merged, shortlist=shortlist)
    if skip_eval:
        return run

    def scored() -> DataFrame:
        answers = answers_of(evaluated)
        embedding = embedding_scores_of(answers) if embedding_scores_of else None
        scores = V.sample_scores(answers, embedding, stem=stem)
        return scores if state else written(scores, "scores")

    run.scores = stage("scores", scored, model=evaluated, stem=stem, embedding=bool(embedding_scores_of))
    spark = run.scores.sparkSession
    run.gaps = V.detect_gaps(run.scores)
    if not skip_training and replies_to and train:
        run.history = stage(
            "history",
            lambda: improvement_loop(evaluated, answers_of, replies_to, train, max_iterations, stem=stem),
            iterations=max_iterations,
        )
    elif not skip_training and replies_to:
        run.prompts = Y.gap_prompts(run.gaps)
        run.training_rows = stage(
            "training", lambda: Y.chat_rows(Y.synthetic_rows(replies_to(run.prompts)))
        )
    summary = V.summarise(run.scores, category)
    run.record = R.run_records(
        summary,
        F.lit(f"{category}-{strategy}"),
        F.lit(strategy),
        F.array(*[F.lit(m) for m in shortlist]).cast("array<string>"),
    )
    if results_path:
        files.write_evaluation(summary, run.scores.withColumn("dataset", F.lit(category)), results_path)
        run.leaderboard = R.leaderboard(files.read_eval_results(spark, results_path))
    if log_path:
        files.append_runs(run.record, log_path)
    return run


def improvement_loop(
    model: str,
    answers_of: Callable[[str], DataFrame],
    replies_to: Callable[[DataFrame], DataFrame],
    train: Callable[[str, DataFrame, int], str],
    max_iterations: int = 3,
    target: float = K.TARGET_ROUGE,
    stem: bool = True,
) -> DataFrame:
    """Evaluate, find gaps, generate rows, train, again: one history row per iteration.

    Scores and training rows are written once per iteration; only the iteration's mean and
    its two counts come to the driver, to decide whether to go on. Rows are those that
    ``loop_decisions`` judges: iteration, avg_rouge1, n_gaps, n_syn, and the model.
    """
    rows = []
    spark = None
    for iteration in range(1, max_iterations + 1):
        scores = V.sample_scores(answers_of(model), run_judge=False, stem=stem)
        spark = scores.sparkSession
        scores = written(scores, "loop-scores")
        one = V.summarise(scores, f"iter_{iteration}").first()
        mean, gaps, made = (one["avg_rouge1"], len(one["gap_categories"]), 0) if one else (0.0, 0, 0)
        trained = model
        if mean < target and gaps:
            prompts = Y.gap_prompts(V.detect_gaps(scores))
            training = written(Y.chat_rows(Y.synthetic_rows(replies_to(prompts))), "loop-rows")
            made = training.count()
            if made:
                trained = train(model, training, iteration)
        rows.append((iteration, model, float(mean), gaps, made))
        if not made:
            break
        model = trained
    spark = spark or SparkSession.active()
    return spark.createDataFrame(
        rows, "iteration int, model_id string, avg_rouge1 double, n_gaps int, n_syn bigint"
    )
