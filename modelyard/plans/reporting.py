"""Run tracking, reports, artefact round trips and the composed run."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelyard.operators import parameters as P
from modelyard.operators import reports as R
from modelyard.plans import discovery as PD
from modelyard.plans import merging as PM
from modelyard.plans import scoring as PS
from modelyard.plans import training as PT
from modelyard.plans.full_run import full_run, improvement_loop
from modelyard.session import new_shared_path, written
from modelyard.sources import files
from modelyard.sources.views import CATEGORIES, duck, view


def _responses(spark, sf):
    return view(spark, sf, "responses")


def _runs(spark, sf):
    """A run per saved result; every metric that is not stored takes its default."""
    return R.run_records(
        view(spark, sf, "eval_results"), F.concat_ws("-", "model_id", "dataset"), F.lit("ties")
    )


def _scored_once(spark, sf):
    """Score rows written once: the summary and the saved rows read the same table."""
    return written(PS._scores(spark, sf), "scores")


def _saved_evaluation(spark, sf):
    path = new_shared_path(spark, "evaluations")
    scores = _scored_once(spark, sf)
    files.write_evaluation(PS.V.summarise(scores, "chat"), scores.withColumn("dataset", F.lit("chat")), path)
    return path


def _saved_twins(spark, sf):
    """Summaries saved three times, under ids that differ only in "/" and "_"."""
    path = new_shared_path(spark, "evaluations")
    ids = F.array(*[F.concat(F.lit(p), "model_id") for p in TWINS])
    scores = _scored_once(spark, sf)
    twins = PS.V.summarise(scores, "chat").withColumn("model_id", F.explode(ids))
    files.write_evaluation(twins, scores.withColumn("dataset", F.lit("chat")), path)
    return files.read_eval_results(spark, path)


def _reread_scores(spark, sf):
    schema = "model_id string, sample_id string, rouge1 double, hallucinated boolean, judge_score double, dataset string"
    rows = spark.read.schema(schema).json(_saved_evaluation(spark, sf) + "/sample_scores")
    return PS._r6(rows, "rouge1")


def _discovery_sink(spark, sf):
    path = new_shared_path(spark, "candidates")
    files.write_candidates(PD._all(spark, sf).drop("kw_ord", "rank"), path)
    return files.read_candidates(spark, path).select(
        "category", "place", "model_id", F.round("score", 6).alias("score"), "notes"
    )


def _param_sink(spark, sf):
    path = new_shared_path(spark, "params")
    files.write_params(view(spark, sf, "params"), path)
    return P.elements(spark.read.parquet(path)).select(
        "model_id", "tensor", "idx", F.col("value").cast("double").alias("value")
    )


def _run_log(spark, sf):
    path = new_shared_path(spark, "runs")
    files.append_runs(_runs(spark, sf), path)
    files.append_runs(_runs(spark, sf).withColumn("notes", F.lit("again")), path)
    return spark.read.parquet(path).select(
        "run_name", "model_id", "avg_rouge1", "notes"
    )


def run_code_category(spark, sf, **skip):
    """The composed run over the derived tables.

    Weights of the shortlisted ids are those of m0, m1, m2; answers come from the
    whole sample table and replies from the whole reply table of the same gap.
    """

    def weights_of(ids):
        names = F.create_map(*[F.lit(x) for i, m in enumerate(ids) for x in (f"m{i}", m)])
        return (
            view(spark, sf, "params")
            .withColumn("model_id", names[F.col("model_id")])
            .filter(F.col("model_id").isNotNull())
        )

    return full_run(
        "code",
        view(spark, sf, "models"),
        view(spark, sf, "cards"),
        weights_of=weights_of,
        answers_of=lambda model: view(spark, sf, "samples").withColumn("model_id", F.lit(model)),
        replies_to=lambda prompts: view(spark, sf, "llm_raw").join(
            prompts.select("gap_cat"), "gap_cat", "left_semi"
        ),
        embedding_scores_of=lambda answers: PS.S.embedding_f1(
            view(spark, sf, "token_vecs")
            .filter(F.col("model_id") != "m9")
            .drop("model_id")
            .join(answers.select(*PS.KEY), "sample_id"),
            PS.BASELINE,
        ),
        categories=CATEGORIES,
        **skip,
    )


def _loop_history(spark, sf):
    """Training is played by answers that turn into the reference, a quarter a time."""

    def answers_of(model):
        better = F.col("ord") % 4 < int(model.rsplit("+", 1)[-1])
        return view(spark, sf, "samples").withColumns(
            {"model_id": F.lit(model), "prediction": F.when(better, F.col("reference")).otherwise(F.col("prediction"))}
        )

    def replies_to(prompts):
        return view(spark, sf, "llm_raw").join(prompts.select("gap_cat"), "gap_cat", "left_semi")

    history = improvement_loop("x+0", answers_of, replies_to, lambda model, rows, i: f"x+{i}", target=LOOP_TARGET)
    return history.withColumn("avg_rouge1", F.round("avg_rouge1", 6))


def _run_leaderboard(spark, sf):
    path = new_shared_path(spark, "run")
    run = run_code_category(
        spark, sf, skip_merge=True, skip_training=True, results_path=f"{path}/results", log_path=f"{path}/log"
    )
    logged = spark.read.parquet(f"{path}/log").select(F.col("model_id").alias("logged"))
    return run.leaderboard.join(logged, F.col("model") == F.col("logged")).select(
        "rank", "model", "dataset", "rouge1", "faithfulness", "judge", "hallucination"
    )


def _run_record(spark, sf):
    record = run_code_category(spark, sf).record
    return PS._r6(
        record.withColumn("base_models", F.array_join("base_models", ",")).withColumn(
            "gap_categories", F.array_join("gap_categories", ",")
        ),
        *R._METRICS,
    )


def _run_weights(spark, sf):
    return P.elements(run_code_category(spark, sf, skip_eval=True).merged, "tensor").select(
        "tensor", "idx", F.round(F.col("value").cast("double"), 6).alias("value")
    )


TWINS = ["", "o/", "o_"]
LOOP_TARGET = 0.95

QUERIES = {
    "R1_workload_prompts": lambda s, d: R.workload(
        _responses(s, d).groupBy("model_id").agg(F.count("*").alias("n_requests"))
    ),
    "R2_request_latency": lambda s, d: R.request_latency(_responses(s, d)).withColumn(
        "latency_ms", F.round("latency_ms", 6)
    ),
    "R3_throughput": lambda s, d: R.throughput(
        _responses(s, d), _responses(s, d).select("model_id").distinct().withColumn("requested", F.lit(80))
    ),
    "R4_run_record": lambda s, d: _runs(s, d)
    .withColumn("base_models", F.array_join("base_models", ","))
    .withColumn("gap_categories", F.array_join("gap_categories", ",")),
    "R5_run_metrics": lambda s, d: R.run_metrics(_runs(s, d)),
    "R6_model_card": lambda s, d: R.model_cards(_runs(s, d), F.col("model_id")),
    "R7_leaderboard": lambda s, d: R.leaderboard(view(s, d, "eval_results")),
    "R8_run_record": _run_record,
    "R8_run_weights": _run_weights,
    "R8_run_leaderboard": _run_leaderboard,
    "R8_loop_history": _loop_history,
    "R8_run_training_rows": lambda s, d: run_code_category(s, d, skip_merge=True).training_rows,
    "R7_leaderboard_from_saved": lambda s, d: R.leaderboard(_saved_twins(s, d)),
    "IO5_eval_results_source": lambda s, d: PS._r6(
        _saved_twins(s, d).withColumn("gap_categories", F.array_join("gap_categories", ",")),
        *PS._MEANS,
    ),
    "IO6_discovery_sink": _discovery_sink,
    "IO7_evaluation_sink": _reread_scores,
    "IO10_parameter_sink": _param_sink,
    "IO11_run_log_sink": _run_log,
}

_RUN = "concat(model_id,'-',dataset)"
_CARD = R._CARD.replace("'", "''")
for _slot, _sql in {
    "model_name": "split_part(model_id,'/',-1)",
    "base_models": "''",
    "merge_strategy": "'ties'",
    "rouge1": "printf('%.3f',avg_rouge1)",
    "rouge2": "'0.000'",
    "rougeL": "'0.000'",
    "bertscore": "printf('%.3f',avg_bertscore)",
    "faithfulness": "printf('%.3f',avg_faithfulness)",
    "hallucination": "'0.0%'",
    "judge": "printf('%.1f',coalesce(avg_judge_score,0))",
    "gaps": "'- None detected'",
    "repo_id": "model_id",
    **{name: f"'{value}'" for name, value in R.CARD_SETTINGS.items()},
}.items():
    _CARD = _CARD.replace("{" + _slot + "}", f"'||{_sql}||'")

_SHORT = PD._SCORED + """, short AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY score DESC,kw_ord,rank) AS place FROM scored WHERE category='code') WHERE place<=5),
named AS (SELECT 'ties_'||string_agg(split_part(model_id,'/',-1),'_' ORDER BY place) FILTER (place<=2) AS merged,
 string_agg(model_id,',' ORDER BY place) AS base_models FROM short)"""
_MERGE2 = """d AS (SELECT f.model_id, f.tensor, f.idx, f.value-b.value AS d FROM params f JOIN params b ON b.model_id='m0'
 AND f.tensor=b.tensor AND f.idx=b.idx AND f.numel=b.numel WHERE f.model_id IN ('m1','m2'))"""
# Three states of one model over the same samples; neither judge nor vectors are used.
_LOOPED = (
    PS._ALL.replace("WITH RECURSIVE ", """WITH RECURSIVE looped AS (SELECT s.* REPLACE ('x+'||i AS model_id,
 sample_id||'/'||i AS sample_id, CASE WHEN ord%4<i THEN reference ELSE prediction END AS prediction) FROM samples s, range(3) t(i)), """)
    .replace("FROM samples", "FROM looped")
    .replace("JOIN samples", "JOIN looped")
    .replace("looped s, range(3)", "samples s, range(3)")
    .replace("coalesce(bertscore_f1,0) AS bertscore_f1", "0e0 AS bertscore_f1")
    .replace(f"{PS._judge('judge_raw')} AS judge_score", "5e0 AS judge_score")
)
_TWINS = "twins AS (SELECT summary.* REPLACE (p||model_id AS model_id) FROM summary, (VALUES (''),('o/'),('o_')) v(p))"
ORACLE = {
    "R1_workload_prompts": duck(
        "responses",
        """WITH n AS (SELECT model_id, least(count(*),50) AS n FROM responses GROUP BY model_id)
SELECT model_id, CAST(pos AS INTEGER) AS pos, 'Explain the concept of '||(['machine learning','quantum computing','climate change','evolution','blockchain'])[pos%5+1]||' in detail.' AS prompt
FROM (SELECT model_id, unnest(range(n)) AS pos FROM n)""",
    ),
    "R2_request_latency": duck(
        "responses",
        """SELECT model_id, batch_id, turn, tokens_used, round(avg(elapsed_ms) OVER (PARTITION BY model_id,batch_id),6) AS latency_ms FROM responses""",
    ),
    "R3_throughput": duck(
        "responses",
        """SELECT model_id, CAST(80 AS BIGINT) AS n_requests, CAST(sum(tokens_used) AS BIGINT) AS total_tokens,
 CAST(printf('%.2f',CAST(sum(elapsed_ms) AS DOUBLE)/1000) AS DOUBLE) AS elapsed_s,
 CAST(printf('%.1f',CAST(sum(tokens_used) AS DOUBLE)/(CAST(sum(elapsed_ms) AS DOUBLE)/1000)) AS DOUBLE) AS tokens_per_sec,
 CAST(printf('%.1f',CAST(sum(elapsed_ms) AS DOUBLE)/80) AS DOUBLE) AS avg_latency_ms FROM responses GROUP BY model_id""",
    ),
    "R4_run_record": duck(
        "eval_results",
        f"""SELECT {_RUN} AS run_name, model_id, 'ties' AS merge_strategy, '' AS base_models, avg_rouge1, 0e0 AS avg_rouge2, 0e0 AS "avg_rougeL",
 avg_bertscore, avg_faithfulness, 0e0 AS hallucination_rate,
 coalesce(avg_judge_score,0) AS avg_judge_score, 0e0 AS tokens_per_sec, '' AS gap_categories, '' AS notes FROM eval_results""",
    ),
    "R5_run_metrics": duck(
        "eval_results",
        f"""SELECT {_RUN} AS run_name, model_id, (CASE WHEN n='tokens_per_sec' THEN 'perf/' ELSE 'eval/' END)||n AS tracker_name, n AS bare_name, v AS value FROM (
 SELECT *, unnest(['rouge1','rouge2','rougeL','bertscore','faithfulness','hallucination_rate','judge_score','tokens_per_sec']) AS n,
 unnest([avg_rouge1,0e0,0e0,avg_bertscore,avg_faithfulness,0e0,coalesce(avg_judge_score,0),0e0]) AS v FROM eval_results)""",
    ),
    "R6_model_card": duck(
        "eval_results", f"SELECT {_RUN} AS run_name, model_id, '{_CARD}' AS card FROM eval_results"
    ),
    "R7_leaderboard": duck(
        "eval_results",
        """SELECT CAST(row_number() OVER (ORDER BY avg_rouge1 DESC, f) AS INTEGER) AS rank, right(model_id,40) AS model, dataset, printf('%.3f',avg_rouge1) AS rouge1,
 printf('%.3f',avg_bertscore) AS bertscore, printf('%.3f',avg_faithfulness) AS faithfulness, printf('%.1f',coalesce(avg_judge_score,0)) AS judge, '0.0%' AS hallucination
FROM (SELECT *, 'eval_'||replace(model_id,'/','_')||'_'||dataset||'.json' AS f FROM eval_results ORDER BY avg_rouge1 DESC, f LIMIT 10)""",
    ),
    "R8_run_record": duck(
        "models cards samples token_vecs",
        f"""WITH RECURSIVE {_SHORT}, {PS._SCORES.replace("scores AS (SELECT s.model_id,", "scores AS (SELECT (SELECT merged FROM named) AS model_id,")},
 {PS._FAIL}, {PS._GAPS.replace("JOIN samples s USING (model_id,sample_id)", "JOIN samples s USING (sample_id)")}, {PS._SUMMARY}
SELECT 'code-ties' AS run_name, model_id, 'ties' AS merge_strategy, (SELECT base_models FROM named) AS base_models, {PS._ROUND.replace('avg_rougeL,6) AS avg_rougeL', 'avg_rougeL,6) AS "avg_rougeL"')},
 0e0 AS tokens_per_sec, gap_categories, '' AS notes FROM summary""",
    ),
    "R8_run_leaderboard": duck(
        "samples token_vecs",
        f"""WITH RECURSIVE {PS._SCORES.replace("scores AS (SELECT s.model_id,", "scores AS (SELECT 'base' AS model_id,")},
 {PS._FAIL}, {PS._GAPS.replace("JOIN samples s USING (model_id,sample_id)", "JOIN samples s USING (sample_id)")}, {PS._SUMMARY}
SELECT CAST(1 AS INTEGER) AS rank, 'base' AS model, 'code' AS dataset, printf('%.3f',avg_rouge1) AS rouge1, printf('%.3f',avg_faithfulness) AS faithfulness,
 printf('%.1f',avg_judge_score) AS judge, printf('%.1f',hallucination_rate*100)||'%' AS hallucination FROM summary""",
    ),
    "R8_loop_history": duck(
        "samples token_vecs llm_raw",
        f"""{_LOOPED} , {PT._ITEMS.replace("sized AS", "sized_r AS")},
made AS (SELECT g.model_id, count(*) AS n_syn FROM syn JOIN gaps g USING (gap_cat) WHERE context<>'' AND question<>'' AND answer<>'' GROUP BY g.model_id),
runs AS (SELECT CAST(right(model_id,1) AS INTEGER)+1 AS iteration, s.model_id, round(avg_rouge1,6) AS avg_rouge1,
 CAST(CASE WHEN gap_categories='' THEN 0 ELSE len(string_split(gap_categories,',')) END AS INTEGER) AS n_gaps,
 CASE WHEN avg_rouge1<{LOOP_TARGET} THEN coalesce(n_syn,0) ELSE 0 END AS n_syn FROM summary s LEFT JOIN made USING (model_id))
SELECT * FROM runs r WHERE NOT EXISTS (SELECT 1 FROM runs e WHERE e.iteration<r.iteration AND e.n_syn=0)""",
    ),
    "R8_run_weights": duck(
        "params",
        f"WITH {PM._TRIM.replace(PM._DELTA, _MERGE2)}, {PM._ELECT}, {PM._MERGE}, {PM._BASE} {PM._OUT}",
    ),
    "R8_run_training_rows": duck(
        "samples llm_raw token_vecs",
        f"""WITH RECURSIVE {PS._SCORES.replace("scores AS (SELECT s.model_id,", "scores AS (SELECT 'x' AS model_id,")}, {PS._FAIL},
 {PS._GAPS.replace("JOIN samples s USING (model_id,sample_id)", "JOIN samples s USING (sample_id)")}, {PT._ITEMS.replace("sized AS", "sized_r AS")}
SELECT {PT._CHAT_TEXT} AS text, gap_cat FROM syn WHERE context<>'' AND question<>'' AND answer<>'' AND gap_cat IN (SELECT gap_cat FROM gaps)""",
    ),
    "IO5_eval_results_source": duck(
        "samples token_vecs",
        f"{PS._ALL}, {_TWINS} SELECT model_id, dataset, n_samples, {PS._ROUND}, gap_categories FROM twins",
    ),
    "R7_leaderboard_from_saved": duck(
        "samples token_vecs",
        f"""{PS._ALL}, {_TWINS} SELECT CAST(row_number() OVER (ORDER BY avg_rouge1 DESC, f, model_id) AS INTEGER) AS rank, right(model_id,40) AS model, dataset,
 printf('%.3f',avg_rouge1) AS rouge1, printf('%.3f',avg_bertscore) AS bertscore, printf('%.3f',avg_faithfulness) AS faithfulness,
 printf('%.1f',avg_judge_score) AS judge, printf('%.1f',hallucination_rate*100)||'%' AS hallucination
FROM (SELECT *, 'eval_'||replace(model_id,'/','_')||'_'||dataset||'.json' AS f FROM twins ORDER BY avg_rouge1 DESC, f, model_id LIMIT 10)""",
    ),
    "IO6_discovery_sink": PD.ORACLE["D14_all_categories"],
    "IO7_evaluation_sink": duck(
        "samples token_vecs",
        f"WITH RECURSIVE {PS._SCORES} SELECT model_id, sample_id, round(rouge1,6) AS rouge1, hallucinated, judge_score, 'chat' AS dataset FROM scores",
    ),
    "IO10_parameter_sink": PM.ORACLE["M12_bfloat16"],
    "IO11_run_log_sink": duck(
        "eval_results",
        f"""SELECT {_RUN} AS run_name, model_id, avg_rouge1, notes FROM eval_results, (VALUES (''),('again')) v(notes)""",
    ),
}
