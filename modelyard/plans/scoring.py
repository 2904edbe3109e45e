"""Answer scoring and evaluation queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelyard.functions import text as X
from modelyard.operators import evaluation as V
from modelyard.operators import keywords as I
from modelyard.operators import replies as M
from modelyard.operators import scoring as S
from modelyard.plans.stem_sql import stems_cte
from modelyard.session import new_shared_path
from modelyard.sources.views import duck, view

KEY = S.KEY
MODELS = ["m0", "m1", "m2"]
BASELINE = 0.1


def _samples(spark, sf):
    return view(spark, sf, "samples")


def _r6(df, *names):
    for n in names:
        df = df.withColumn(n, F.round(n, 6))
    return df


def _scores(spark, sf):
    """m9, whose vectors lie beside those of the samples' models, answers none of the samples."""
    vectors = view(spark, sf, "token_vecs").filter(F.col("model_id") != "m9")
    embedding = S.embedding_f1(vectors, BASELINE)
    return V.sample_scores(_samples(spark, sf), embedding)


def _summary(spark, sf):
    return V.summarise(_scores(spark, sf), "chat")


def _echo():
    """Stand-in for a user's model: respells the question of each prompt."""

    def call(prompts):
        if any("\nQuestion: Summarize " in p for p in prompts):
            raise RuntimeError("this model cannot answer that")
        return [" " + p.rsplit("\nQuestion: ", 1)[-1].replace("e", "3") + " " for p in prompts]

    return call


def _called(spark, sf):
    prompts = _samples(spark, sf).select(*KEY, S.qa_prompt().alias("prompt"))
    return S.batched_call(prompts, "prompt", "reply", _echo).select(*KEY, "reply")


def _mute():
    """A model that answers nothing: what it returns was not asked of it."""
    return lambda prompts: [None] * len(prompts)


def _remembered(spark, sf):
    """Replies asked for once, then read back by a run whose model answers nothing."""
    prompts = _samples(spark, sf).select(*KEY, S.qa_prompt().alias("prompt"))
    store = new_shared_path(spark, "replies")
    M.remembered_call(prompts, "prompt", "reply", _echo, "echo", store)
    return M.remembered_call(prompts, "prompt", "reply", _mute, "echo", store).select(*KEY, "reply")


def _judged(spark, sf):
    both = F.array(
        F.struct(F.lit("a").alias("model_id"), F.col("judge_raw").alias("raw")),
        F.struct(F.lit("b").alias("model_id"), F.col("judge_raw_b").alias("raw")),
    )
    rows = _samples(spark, sf).select("sample_id", F.inline(both))
    judged = rows.select("model_id", "sample_id", S.judge_score(F.col("raw")).alias("judge_score"))
    return S.pairwise_verdict(judged, "a", "b")


_MEANS = list(V.MEANS)

QUERIES = {
    "E1_qa_prompt": lambda s, d: _samples(s, d).select(*KEY, S.qa_prompt().alias("prompt")),
    "E2_batched_model_call": _called,
    "E2_remembered_model_call": _remembered,
    "E3_tokens": lambda s, d: S.with_tokens(_samples(s, d), stem=False).select(
        *KEY, F.posexplode("pred").alias("pos", "token")
    ),
    "E3_stems": lambda s, d: S.with_tokens(_samples(s, d)).select(
        *KEY, F.posexplode("pred").alias("pos", "token")
    ),
    "E4_rouge1": lambda s, d: _r6(S.rouge(_samples(s, d), False).select(*KEY, "rouge1"), "rouge1"),
    "E5_rouge2": lambda s, d: _r6(S.rouge(_samples(s, d), False).select(*KEY, "rouge2"), "rouge2"),
    "E6_rougeL": lambda s, d: _r6(S.rouge(_samples(s, d), False).select(*KEY, "rougeL"), "rougeL"),
    "E4_E6_rouge_stemmed": lambda s, d: _r6(S.rouge(_samples(s, d)), "rouge1", "rouge2", "rougeL"),
    "E7_bertscore_f1": lambda s, d: _r6(
        S.embedding_f1(view(s, d, "token_vecs"), BASELINE), "bertscore_f1"
    ),
    "E8_hallucination_patterns": lambda s, d: _samples(s, d).select(
        *KEY, X.hallucination_words(F.col("prediction")).alias("hallucinated")
    ),
    "E9_nli_pair": lambda s, d: _samples(s, d).select(*KEY, S.nli_pair().alias("pair")),
    "E10_faithfulness": lambda s, d: _samples(s, d)
    .withColumn("faithfulness", S.faithfulness(F.col("nli_label"), F.col("nli_score")))
    .select(
        *KEY,
        F.round("faithfulness", 6).alias("faithfulness"),
        S.hallucinated(F.col("prediction"), F.col("faithfulness")).alias("hallucinated"),
    ),
    "E11_judge_prompt": lambda s, d: _samples(s, d).select(*KEY, S.judge_prompt().alias("prompt")),
    "E12_judge_reply": lambda s, d: _samples(s, d).select(
        *KEY,
        S.judge_score(F.col("judge_raw")).alias("score"),
        S.judge_reason(F.col("judge_raw")).alias("reason"),
    ),
    "E13_pairwise_verdict": _judged,
    "E14_sample_scores": lambda s, d: _r6(
        _scores(s, d).drop("ord", "gap_bits", "gap_signals"), "rouge1", "rouge2", "rougeL", "faithfulness", "bertscore_f1"
    ),
    "E15_failing": lambda s, d: V.failing(_scores(s, d)).select(*KEY),
    "E16_gap_categories": lambda s, d: V.detect_gaps(_scores(s, d)),
    "E16_keyword_index": lambda s, d: I.gap_categories(_scores(s, d), _samples(s, d), view(s, d, "gap_keywords")),
    "E17_summary": lambda s, d: _r6(
        _summary(s, d).withColumn("gap_categories", F.array_join("gap_categories", ",")), *_MEANS
    ),
    "E18_compare_models": lambda s, d: _r6(V.compare_models(_summary(s, d), MODELS), *MODELS),
    "E19_threshold_table": lambda s, d: V.threshold_table(_summary(s, d)),
}

_TOK = """toks AS (SELECT model_id, sample_id, list_filter(string_split(regexp_replace(lower(prediction),'[^a-z0-9]+',' ','g'),' '), lambda t: t<>'') AS pred,
 list_filter(string_split(regexp_replace(lower(reference),'[^a-z0-9]+',' ','g'),' '), lambda t: t<>'') AS ref FROM samples)"""


def _stemmed(side: str) -> str:
    return f"""(SELECT model_id, sample_id, list(stem ORDER BY pos) AS {side} FROM (SELECT model_id, sample_id, unnest(range(len({side}))) AS pos, unnest({side}) AS tok
  FROM raw_toks) u JOIN stems USING (tok) GROUP BY ALL)"""


_STEMMED = f"""{_TOK.replace("toks AS", "raw_toks AS")}, {stems_cte("SELECT DISTINCT unnest(pred||ref) AS tok FROM raw_toks")},
toks AS (SELECT model_id, sample_id, coalesce(p.pred,[]) AS pred, coalesce(q.ref,[]) AS ref FROM (SELECT model_id, sample_id FROM samples) s
 LEFT JOIN {_stemmed('pred')} p USING (model_id, sample_id) LEFT JOIN {_stemmed('ref')} q USING (model_id, sample_id))"""
_GRAMS = """grams AS (SELECT model_id, sample_id, 1 AS n, 'p' AS side, unnest(pred) AS g FROM toks
 UNION ALL SELECT model_id, sample_id, 1, 'r', unnest(ref) FROM toks
 UNION ALL SELECT model_id, sample_id, 2, 'p', unnest(list_transform(range(1,len(pred)), lambda i: pred[i]||' '||pred[i+1])) FROM toks
 UNION ALL SELECT model_id, sample_id, 2, 'r', unnest(list_transform(range(1,len(ref)), lambda i: ref[i]||' '||ref[i+1])) FROM toks),
counts AS (SELECT model_id, sample_id, n, g, count(*) FILTER (side='p') AS p, count(*) FILTER (side='r') AS r FROM grams GROUP BY ALL),
rn AS (SELECT model_id, sample_id, coalesce(2e0*sum(least(p,r)) FILTER (n=1)/nullif(sum(p+r) FILTER (n=1),0),0) AS rouge1,
 coalesce(2e0*sum(least(p,r)) FILTER (n=2)/nullif(sum(p+r) FILTER (n=2),0),0) AS rouge2 FROM counts GROUP BY ALL)"""
# t[k] is the earliest reference position that ends a common subsequence of k tokens. A
# prediction token with matches m moves every t[k] to its first match after t[k-1].
_LCS = """pt AS (SELECT model_id, sample_id, unnest(range(1,len(pred)+1)) AS i, unnest(pred) AS tok FROM toks),
rt AS (SELECT model_id, sample_id, unnest(range(1,len(ref)+1)) AS j, unnest(ref) AS tok FROM toks),
matches AS (SELECT model_id, sample_id, i, list(j ORDER BY j) AS m FROM pt JOIN rt USING (model_id, sample_id, tok) GROUP BY ALL),
lcs AS (SELECT model_id, sample_id, len(list_reduce(list(m ORDER BY i), lambda t, m: list_filter(
  list_transform(range(1,len(t)+2), lambda k: least(t[k], list_min(list_filter(m, lambda p: k=1 OR p>t[k-1])))), lambda p: p IS NOT NULL), []::BIGINT[])) AS lcs
 FROM matches GROUP BY model_id, sample_id),
rl AS (SELECT model_id, sample_id, coalesce(2e0*coalesce(lcs,0)/nullif(len(pred)+len(ref),0),0) AS rougeL FROM toks LEFT JOIN lcs USING (model_id, sample_id))"""
_HALL = r"""(regexp_matches(prediction,'\b(definitely|certainly|always|never|everyone|nobody)\b','i') OR regexp_matches(prediction,'\b(100%|absolutely|guaranteed)\b','i')
 OR regexp_matches(prediction,'\bin \d{4},? .{0,30} (invented|discovered|created|founded)\b','i'))"""
_FAITH = """(CASE upper(coalesce(nli_label,'')) WHEN 'ENTAILMENT' THEN nli_score WHEN 'CONTRADICTION' THEN 1-nli_score ELSE 0.5e0 END)"""


def _judge(col: str) -> str:
    return rf"least(10e0, coalesce(TRY_CAST(nullif(regexp_extract({col},'SCORE:\s*(\d+)',1),'') AS DOUBLE),5e0))"


_BERT = f"""vm AS (SELECT p.model_id, p.sample_id, p.pos AS pp, r.pos AS rp,
  list_inner_product(p.vec::DOUBLE[],r.vec::DOUBLE[])/sqrt(list_inner_product(p.vec::DOUBLE[],p.vec::DOUBLE[])*list_inner_product(r.vec::DOUBLE[],r.vec::DOUBLE[])) AS c
 FROM token_vecs p JOIN token_vecs r ON p.model_id=r.model_id AND p.sample_id=r.sample_id AND p.side='pred' AND r.side='ref'),
va AS (SELECT model_id, sample_id, avg(c) AS p FROM (SELECT model_id, sample_id, pp, max(c) AS c FROM vm GROUP BY ALL) GROUP BY ALL),
vb AS (SELECT model_id, sample_id, avg(c) AS r FROM (SELECT model_id, sample_id, rp, max(c) AS c FROM vm GROUP BY ALL) GROUP BY ALL),
bert AS (SELECT model_id, sample_id, (coalesce(2*p*r/nullif(p+r,0),0)-{BASELINE})/(1-{BASELINE}::DOUBLE) AS bertscore_f1
 FROM (SELECT DISTINCT model_id, sample_id FROM token_vecs) LEFT JOIN va USING (model_id, sample_id) LEFT JOIN vb USING (model_id, sample_id))"""
_SCORES = f"""{_STEMMED}, {_GRAMS}, {_LCS}, {_BERT}, scores AS (SELECT s.model_id, s.sample_id, s.ord, rouge1, rouge2, rougeL, coalesce(bertscore_f1,0) AS bertscore_f1,
 {_FAITH} AS faithfulness, {_HALL} OR {_FAITH}<0.3e0 AS hallucinated, {_judge('judge_raw')} AS judge_score
 FROM samples s JOIN rn USING (model_id,sample_id) JOIN rl USING (model_id,sample_id) LEFT JOIN bert USING (model_id,sample_id))"""
_FAIL = "failing AS (SELECT * FROM scores WHERE rouge1<0.3e0 OR bertscore_f1<0.5e0 OR faithfulness<0.5e0 OR judge_score<5 OR hallucinated)"
_GAPS = """cats AS (SELECT * FROM (VALUES (0,'factual_recall',['who','when','where','what year','which country']),
 (1,'multi_step_reasoning',['therefore','because','if','then','step']),(2,'numerical',['how many','calculate','percent','number','count']),
 (3,'code_generation',['write a function','implement','code','python','sql']),(4,'summarization',['summarize','summary','main points','briefly'])) c(cat_ord,gap_cat,words)),
gaps AS (SELECT f.model_id, cat_ord, gap_cat, count(*) AS failures, min(f.ord) AS first_ord
 FROM failing f JOIN samples s USING (model_id,sample_id) JOIN cats
 ON len(list_filter(words, lambda w: contains(lower(s.question||' '||s.context),w)))>0 GROUP BY ALL HAVING count(*)>=2)"""
_SUMMARY = """summary AS (SELECT s.model_id, 'chat' AS dataset, count(*) AS n_samples, avg(rouge1) AS avg_rouge1, avg(rouge2) AS avg_rouge2, avg(rougeL) AS avg_rougeL,
 avg(bertscore_f1) AS avg_bertscore, avg(faithfulness) AS avg_faithfulness, avg(CAST(hallucinated AS INT)) AS hallucination_rate,
 avg(judge_score) AS avg_judge_score, coalesce(any_value(gl),'') AS gap_categories
 FROM scores s LEFT JOIN (SELECT model_id, string_agg(gap_cat,',' ORDER BY first_ord,cat_ord) AS gl FROM gaps GROUP BY model_id) g ON g.model_id=s.model_id GROUP BY s.model_id)"""
_ALL = f"WITH RECURSIVE {_SCORES}, {_FAIL}, {_GAPS}, {_SUMMARY}"
_ROUND = ", ".join(f"round({m},6) AS {m}" for m in _MEANS)
_PICK = ", ".join(f"round(max({{c}}) FILTER (model_id='{m}'),6) AS {m}" for m in MODELS)
_JUDGE_SQL = X.K.JUDGE_PROMPT.replace("'", "''")
for _slot in ("question", "reference", "prediction"):
    _JUDGE_SQL = _JUDGE_SQL.replace("{" + _slot + "}", f"'||{_slot}||'")

ORACLE = {
    "E1_qa_prompt": duck(
        "samples",
        "SELECT model_id, sample_id, 'Context: '||context||chr(10)||'Question: '||question||chr(10)||'Answer:' AS prompt FROM samples",
    ),
    "E2_batched_model_call": duck(
        "samples",
        """SELECT model_id, sample_id, CASE WHEN NOT starts_with(question,'Summarize ')
 THEN regexp_replace(replace(question||chr(10)||'Answer:','e','3'),'^\\s+|\\s+$','','g') END AS reply FROM samples""",
    ),
    "E3_tokens": duck(
        "samples",
        f"WITH {_TOK} SELECT model_id, sample_id, CAST(unnest(range(len(pred))) AS INTEGER) AS pos, unnest(pred) AS token FROM toks",
    ),
    "E3_stems": duck(
        "samples",
        f"WITH {_STEMMED} SELECT model_id, sample_id, CAST(unnest(range(len(pred))) AS INTEGER) AS pos, unnest(pred) AS token FROM toks",
    ),
    "E4_E6_rouge_stemmed": duck(
        "samples",
        f"""WITH RECURSIVE {_STEMMED}, {_GRAMS}, {_LCS} SELECT model_id, sample_id, round(coalesce(rouge1,0),6) AS rouge1, round(coalesce(rouge2,0),6) AS rouge2,
 round(rougeL,6) AS "rougeL" FROM rl LEFT JOIN rn USING (model_id, sample_id)""",
    ),
    "E4_rouge1": duck(
        "samples", f"WITH {_TOK}, {_GRAMS} SELECT model_id, sample_id, round(rouge1,6) AS rouge1 FROM rn"
    ),
    "E5_rouge2": duck(
        "samples", f"WITH {_TOK}, {_GRAMS} SELECT model_id, sample_id, round(rouge2,6) AS rouge2 FROM rn"
    ),
    "E6_rougeL": duck(
        "samples",
        f'WITH RECURSIVE {_TOK}, {_LCS} SELECT model_id, sample_id, round(rougeL,6) AS "rougeL" FROM rl',
    ),
    "E7_bertscore_f1": duck(
        "token_vecs", f"WITH {_BERT} SELECT model_id, sample_id, round(bertscore_f1,6) AS bertscore_f1 FROM bert"
    ),
    "E8_hallucination_patterns": duck(
        "samples", f"SELECT model_id, sample_id, {_HALL} AS hallucinated FROM samples"
    ),
    "E9_nli_pair": duck(
        "samples",
        "SELECT model_id, sample_id, substring(context,1,512)||' [SEP] '||substring(prediction,1,256) AS pair FROM samples",
    ),
    "E10_faithfulness": duck(
        "samples",
        f"SELECT model_id, sample_id, round({_FAITH},6) AS faithfulness, {_HALL} OR {_FAITH}<0.3e0 AS hallucinated FROM samples",
    ),
    "E11_judge_prompt": duck(
        "samples", f"SELECT model_id, sample_id, '{_JUDGE_SQL}' AS prompt FROM samples"
    ),
    "E12_judge_reply": duck(
        "samples",
        rf"""SELECT model_id, sample_id, {_judge('judge_raw')} AS score, trim(coalesce(regexp_extract(judge_raw,'REASON:\s*(.+)',1),'')) AS reason FROM samples""",
    ),
    "E13_pairwise_verdict": duck(
        "samples",
        f"""SELECT sample_id, CASE WHEN score_a>=score_b THEN 'a' ELSE 'b' END AS winner, score_a, score_b, abs(score_a-score_b) AS delta
 FROM (SELECT sample_id, {_judge('judge_raw')} AS score_a, {_judge('judge_raw_b')} AS score_b FROM samples)""",
    ),
    "E14_sample_scores": duck(
        "samples token_vecs",
        f"""WITH RECURSIVE {_SCORES} SELECT model_id, sample_id, round(rouge1,6) AS rouge1, round(rouge2,6) AS rouge2, round(rougeL,6) AS "rougeL",
 round(bertscore_f1,6) AS bertscore_f1, round(faithfulness,6) AS faithfulness, hallucinated, judge_score FROM scores""",
    ),
    "E15_failing": duck(
        "samples token_vecs", f"WITH RECURSIVE {_SCORES}, {_FAIL} SELECT model_id, sample_id FROM failing"
    ),
    "E16_gap_categories": duck(
        "samples token_vecs", f"WITH RECURSIVE {_SCORES}, {_FAIL}, {_GAPS} SELECT * FROM gaps"
    ),
    "E16_keyword_index": duck(
        "samples token_vecs gap_keywords",
        f"""WITH RECURSIVE {_SCORES}, {_FAIL} SELECT model_id, cat_ord, gap_cat, count(*) AS failures, min(ord) AS first_ord FROM (
 SELECT DISTINCT f.model_id, f.sample_id, f.ord, cat_ord, gap_cat FROM failing f JOIN samples s USING (model_id,sample_id)
 JOIN gap_keywords k ON contains(lower(s.question||' '||s.context),k.keyword)) GROUP BY ALL HAVING count(*)>=2""",
    ),
    "E17_summary": duck(
        "samples token_vecs", f"{_ALL} SELECT model_id, dataset, n_samples, {_ROUND}, gap_categories FROM summary"
    ),
    "E18_compare_models": duck(
        "samples token_vecs",
        _ALL
        + " UNION ALL ".join(
            f" SELECT {i} AS metric_ord, '{label}' AS metric, {_PICK.format(c=c)} FROM summary"
            for i, (label, c) in enumerate(X.K.COMPARED.items())
        ),
    ),
    "E19_threshold_table": duck(
        "samples token_vecs",
        _ALL
        + " UNION ALL ".join(
            f" SELECT model_id, {i} AS metric_ord, '{label}' AS metric, {score} AS score, '{limit}' AS threshold FROM summary"
            for i, (label, score, limit) in enumerate(
                [
                    ("ROUGE-1", "printf('%.3f',avg_rouge1)", "0.30"),
                    ("ROUGE-2", "printf('%.3f',avg_rouge2)", "—"),
                    ("ROUGE-L", "printf('%.3f',avg_rougeL)", "—"),
                    ("BERTScore F1", "printf('%.3f',avg_bertscore)", "0.50"),
                    ("Faithfulness", "printf('%.3f',avg_faithfulness)", "0.50"),
                    ("Hallucination %", "printf('%.1f',hallucination_rate*100)||'%'", "< 10%"),
                    ("Judge Score", "printf('%.1f',avg_judge_score)||'/10'", "5/10"),
                ]
            )
        ),
    ),
}
ORACLE["E2_remembered_model_call"] = ORACLE["E2_batched_model_call"]
