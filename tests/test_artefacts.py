import json

import pytest
from pyspark.sql import functions as F

from modelyard.operators import evaluation as V
from modelyard.operators import reports as R
from modelyard.plans.full_run import full_run
from modelyard.sources import files


def lines(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    return str(path)


SAMPLE = {"id": "1", "context": "c", "question": "q", "reference": "r"}


def test_custom_samples(spark, tmp_path):
    good = lines(tmp_path / "good.jsonl", [{**SAMPLE, "id": str(i)} for i in range(30)] + [{**SAMPLE, "prediction": "p"}])
    df = files.read_custom_samples(spark, good)
    assert df.count() == 31 and {r.prediction for r in df.collect()} == {"", "p"}
    assert [r.id for r in files.read_custom_samples(spark, good, 3).collect()] == ["0", "1", "2"]
    for bad in ({**SAMPLE, "more": 1}, {k: v for k, v in SAMPLE.items() if k != "reference"}):
        path = lines(tmp_path / f"bad{len(bad)}.jsonl", [SAMPLE, bad])
        with pytest.raises(Exception, match="not a sample line"):
            files.read_custom_samples(spark, path).collect()


def test_eval_results_skip_unreadable_files(spark, tmp_path):
    (tmp_path / "eval_a.json").write_text(json.dumps({"model_id": "a", "dataset": "d", "avg_rouge1": 0.2, "sample_scores": [{"x": 1}]}, indent=2))
    (tmp_path / "eval_b.json").write_text("{broken")
    (tmp_path / "eval_c.json").write_text(json.dumps({"model_id": "c/long", "dataset": "d", "avg_rouge1": 0.2}))
    (tmp_path / "other.json").write_text(json.dumps({"model_id": "o"}))
    got = files.read_eval_results(spark, str(tmp_path))
    assert got.count() == 2 and files.unreadable_results(spark, str(tmp_path)) == 1
    board = R.leaderboard(got).orderBy("rank").collect()
    assert [(r.rank, r.model, r.rouge1, r.judge) for r in board] == [(1, "a", "0.200", "0.0"), (2, "c/long", "0.200", "0.0")]


def test_a_file_with_several_results_loses_none(spark, tmp_path):
    rows = [{"model_id": m, "dataset": "d", "avg_rouge1": v} for m, v in (("o/a", 0.5), ("o/b", 0.5), ("o_a", 0.7))]
    lines(tmp_path / "eval_many.json", rows)
    (tmp_path / "eval_list.json").write_text("[1, 2]")
    (tmp_path / "eval_two.json").write_text("\n".join(json.dumps(r, indent=1) for r in rows))
    assert files.unreadable_results(spark, str(tmp_path)) == 2
    got = files.read_eval_results(spark, str(tmp_path))
    assert sorted(r.model_id for r in got.collect()) == ["o/a", "o/b", "o_a"]
    schema = "model_id string, dataset string, n_samples bigint, avg_rouge1 double"
    df = spark.createDataFrame([("o/a", "d", 1, 0.5), ("o_a", "d", 1, 0.5), ("o/b", "d", 2, 0.7)], schema)
    scores = spark.createDataFrame([("o/a", "1", "d")], "model_id string, sample_id string, dataset string")
    files.write_evaluation(df.coalesce(1), scores, str(tmp_path / "own"))
    board = R.leaderboard(files.read_eval_results(spark, str(tmp_path / "own"))).orderBy("rank").collect()
    assert [r.model for r in board] == ["o/b", "o/a", "o_a"]


def test_a_large_file_of_results_is_read_by_many_tasks(spark, tmp_path):
    """Small splits: records are found within them, none is lost or cut, other files are whole."""
    rows = [{"model_id": f"o/{i}", "dataset": "d ü \n" * (i % 7), "avg_rouge1": i / 3000} for i in range(3000)]
    lines(tmp_path / "eval_large.json", rows)
    wide = {"model_id": "wide", "dataset": "d", "avg_rouge1": 1.0, "sample_scores": [{"rouge1": k} for k in range(800)]}
    (tmp_path / "eval_wide.json").write_text("\n  \n" + json.dumps(wide, indent=2))
    (tmp_path / "eval_cut.json").write_text(json.dumps(wide, indent=2)[:-9])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = files.read_eval_results(spark, str(tmp_path))
        tasks = spark.read.text(str(tmp_path), pathGlobFilter="eval_large.json").rdd.getNumPartitions()
        assert tasks > 10 and "wholetext" not in got._jdf.queryExecution().toString().lower()
        found = {r.model_id: (r.dataset, r.avg_rouge1) for r in got.collect()}
        assert files.unreadable_results(spark, str(tmp_path)) == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == {r["model_id"]: (r["dataset"], r["avg_rouge1"]) for r in [*rows, wide]}


def test_evaluation_rerun_replaces_only_its_part(spark, tmp_path):
    def summary(model, value):
        return spark.createDataFrame(
            [(model, "d", 1, value)], "model_id string, dataset string, n_samples bigint, avg_rouge1 double"
        )

    scores = spark.createDataFrame([("m", "1", "d")], "model_id string, sample_id string, dataset string")
    for model, value in (("o/a", 0.1), ("o/b", 0.2), ("o/a", 0.3)):
        files.write_evaluation(summary(model, value), scores, str(tmp_path))
    got = {r.model_id: r.avg_rouge1 for r in files.read_eval_results(spark, str(tmp_path)).collect()}
    assert got == {"o/a": 0.3, "o/b": 0.2}


def test_run_log_failure_is_a_warning(spark, tmp_path):
    runs = spark.range(1)
    blocked = tmp_path / "file"
    blocked.write_text("x")
    assert files.append_runs(runs, str(tmp_path / "runs")) is True
    assert files.append_runs(runs, str(blocked / "below")) is False


def test_gaps_need_two_failures_and_keep_first_order(spark):
    rows = [
        ("m", "1", 1, "please summarize", "x"), ("m", "2", 2, "who is it", "a different thing"),
        ("m", "3", 3, "who", "summary"), ("m", "4", 4, "count of sql", ""),
    ]
    samples = spark.createDataFrame(rows, "model_id string, sample_id string, ord int, question string, context string")
    scored = V.with_gap_bits(samples).selectExpr(
        "*", "0.9D rouge1", "0.9D rouge2", "0.9D rougeL", "0.9D bertscore_f1", "0.9D faithfulness",
        "9D judge_score", "ord < 4 as hallucinated",
    )
    got = V.summarise(scored).first()
    assert got.gap_categories == ["summarization", "factual_recall"]
    assert got.hallucination_rate == 0.75 and got.n_samples == 4
    assert {(r.gap_cat, r.failures) for r in V.detect_gaps(scored).collect()} == {("summarization", 2), ("factual_recall", 2)}


def test_thresholds_are_strict(spark):
    df = spark.createDataFrame(
        [(0.30, 0.50, 0.50, 5.0, False), (0.29, 0.9, 0.9, 9.0, False), (0.9, 0.9, 0.9, 9.0, True)],
        "rouge1 double, bertscore_f1 double, faithfulness double, judge_score double, hallucinated boolean",
    )
    assert V.failing(df).count() == 2


def test_model_card(spark):
    summary = spark.createDataFrame([("o/m", 0.42, 0.125)], "model_id string, avg_rouge1 double, hallucination_rate double")
    run = R.run_records(summary, F.lit("r"), F.lit("ties"), F.array(F.lit("a"), F.lit("b")))
    card = R.model_cards(run, F.lit("org/name"), scale="3B parameters", density="0.4").first().card
    assert "| Scale          | 3B parameters |" in card and "(TIES/Breadcrumbs): 0.4" in card and "{" not in card
    assert "# name\n" in card and "| Base models    | `a`, `b` |" in card
    assert "| ROUGE-1            | 0.420 |" in card and "| Hallucination rate | 12.5% |" in card
    assert "- None detected" in card and "| Judge Score        | 0.0/10 |" in card


def test_run_without_candidates_fails(spark):
    models = spark.createDataFrame(
        [("x/y", 1, 1, "t", "text-generation", ["1b"])],
        "model_id string, downloads bigint, likes bigint, pipeline_tag string, task string, tags array<string>",
    )
    cards = spark.createDataFrame([], "model_id string, card_text string")
    with pytest.raises(RuntimeError, match="no candidates"):
        full_run("code", models, cards)
    assert full_run("code", skip_discover=True, skip_eval=True, base_model="b").evaluated_model == "b"


def test_throughput_and_workload(spark):
    df = spark.createDataFrame([("m", 1, 0, 10, 500), ("m", 1, 1, 20, 1000), ("m", 2, 0, 5, 250)],
                               "model_id string, batch_id int, turn int, tokens_used bigint, elapsed_ms bigint")
    t = R.throughput(df).first()
    assert (t.n_requests, t.total_tokens, t.elapsed_s, t.tokens_per_sec, t.avg_latency_ms) == (3, 35, 1.75, 20.0, 583.3)
    asked = spark.createDataFrame([("m", 10)], "model_id string, requested int")
    assert R.throughput(df, asked).first().avg_latency_ms == 175.0
    assert {r.latency_ms for r in R.request_latency(df).filter("batch_id = 1").collect()} == {750.0}
    sizes = spark.createDataFrame([("m", 7), ("n", 80)], "model_id string, n_requests int")
    rows = R.workload(sizes).collect()
    assert len(rows) == 57 and rows[5].prompt == "Explain the concept of machine learning in detail."


def test_saved_results_score_their_answers_once(spark, monkeypatch):
    from modelyard.plans import reporting, scoring

    calls, real = [], scoring._scores
    monkeypatch.setattr(scoring, "_scores", lambda s, d: calls.append(d) or real(s, d))
    for saved in (reporting._saved_evaluation, reporting._saved_twins):
        calls.clear()
        saved(spark, "/root/testdata/sf0.001")
        assert len(calls) == 1
