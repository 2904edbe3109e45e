"""Operator inputs derived from the driver tables.

The driver tables hold no models, cards or answers, so each input is shaped from
them over their whole rows and whole texts. A view is one SQL text that both
Spark and DuckDB read; ``{name}`` stands for a driver table or an earlier view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelyard.operators.parameters import chunked
from modelyard.sources.tables import NAMES, table

CATEGORIES = {
    "code": ["ring", "gear"],
    "reasoning": ["bolt", "ring", "hot"],
    "chat": ["anvil"],
    "none": ["zzz"],
}

VIEWS = {
    "models": """
SELECT p_partkey AS ord,
 concat(lower(replace(p_brand,'#','')),'/',replace(p_name,' ','-'),'-',p_size,'b-',p_partkey) AS model_id,
 CASE WHEN p_brand='Brand#7' THEN NULL ELSE d END AS downloads,
 CASE WHEN p_brand='Brand#9' THEN NULL ELSE k END AS likes,
 CASE WHEN p_type='PROMO' THEN NULL WHEN p_type='SMALL' THEN '' ELSE 'text-generation' END AS pipeline_tag,
 CASE WHEN p_type='LARGE' THEN 'fill-mask' ELSE 'text-generation' END AS task,
 CASE WHEN p_brand='Brand#11' THEN NULL ELSE
 split(concat(lower(p_type),',',CASE p_partkey%4 WHEN 0 THEN concat(p_size,'B-instruct') WHEN 1 THEN '4bit'
   WHEN 2 THEN 'en' ELSE concat('base-',p_size,'b') END),',') END AS tags
FROM {part} LEFT JOIN (SELECT l_partkey, cast(sum(l_quantity)*2 AS bigint) AS d, count(*) AS k
  FROM {lineitem} GROUP BY l_partkey) l ON p_partkey=l_partkey""",
    "cards": """
SELECT m.model_id, concat(t.text,CASE WHEN ord%2=0 THEN ' ## Model Details' ELSE '' END,
 CASE WHEN ord%3=0 THEN ' ## INTENDED USES' ELSE '' END,CASE WHEN ord%5=0 THEN ' ## Training' ELSE '' END,
 CASE WHEN ord%7=1 THEN ' ## Evaluation' ELSE '' END,CASE WHEN ord%4=0 THEN ' ## limitations' ELSE '' END) AS card_text
FROM (SELECT model_id, ord, ord%(SELECT count(*) FROM {documents}) AS doc_key FROM {models}) m
JOIN {documents} t ON t.doc_id=m.doc_key WHERE t.lang<>'es'""",
    "samples": """
SELECT concat('m',conv_id%3) AS model_id, concat(conv_id,'-',turn) AS sample_id, conv_id*100+turn AS ord,
 d.text AS context,
 concat(CASE conv_id%5 WHEN 0 THEN 'Who ' WHEN 1 THEN 'How many ' WHEN 2 THEN 'Write a function '
   WHEN 3 THEN 'Summarize ' ELSE '' END,q) AS question,
 CASE WHEN turn%4=0 THEN concat(a,' ',b.text) ELSE concat(q,' ',b.text) END AS reference,
 concat(a,CASE WHEN (conv_id+turn)%7=0 THEN ' definitely' WHEN (conv_id+turn)%7=1 THEN ' In 1921, it was invented' ELSE '' END) AS prediction,
 CASE (conv_id+turn)%4 WHEN 0 THEN 'ENTAILMENT' WHEN 1 THEN 'contradiction' WHEN 2 THEN 'NEUTRAL' ELSE NULL END AS nli_label,
 ((conv_id*37+turn*11)%100)/100e0 AS nli_score,
 CASE WHEN conv_id%5=4 THEN 'no score' WHEN conv_id%11=3 THEN NULL
   ELSE concat('SCORE: ',(conv_id*7+turn)%13,' REASON: r',turn) END AS judge_raw,
 concat('SCORE: ',(conv_id*5+turn*3)%13,' REASON: s',turn) AS judge_raw_b
FROM (SELECT u.conv_id, u.turn, u.text AS q, v.text AS a,
   u.conv_id%(SELECT count(*) FROM {documents}) AS doc_key, u.conv_id%(SELECT count(*) FROM {benchmark}) AS item_key
  FROM {conversations} u JOIN {conversations} v ON u.conv_id=v.conv_id AND v.turn=u.turn+1
  WHERE u.role='user' AND v.role='assistant'
  UNION ALL SELECT 100000000000+doc_id, 1, concat('What does document ',doc_id,' from ',source,' say?'), text, doc_id,
   doc_id%(SELECT count(*) FROM {benchmark}) FROM {documents}) c
JOIN {documents} d ON d.doc_id=c.doc_key JOIN {benchmark} b ON b.item_id=c.item_key""",
    "qa_raw": """
SELECT ord, context, question, CASE WHEN nli_label IS NULL THEN NULL ELSE reference END AS answer FROM {samples}""",
    "llm_raw": """
SELECT conv_id*100+turn AS raw_id, CASE conv_id%5 WHEN 0 THEN 'factual_recall' WHEN 1 THEN 'numerical'
  WHEN 2 THEN 'code_generation' WHEN 3 THEN 'summarization' ELSE 'unknown_gap' END AS gap_cat,
 CASE (conv_id+turn)%6 WHEN 0 THEN concat('[{{"context":"',t,'","question":"q',turn,'","answer":"a"}}]')
  WHEN 1 THEN concat('Here: [{{"context":"c',conv_id,'","question":"',t,'","answer":"a"}},{{"context":"","question":"q","answer":"z"}}] done')
  WHEN 2 THEN text WHEN 3 THEN concat('[{{"context":1,"question":null,"answer":true}},5,{{"answer":"',t,'"}},{{"context":',raw_num,',"question":1.0,"answer":-2.50}}]')
  WHEN 4 THEN '[a] then [{{"context":"z"}}]' ELSE concat('{{"context":"',t,'"}}') END AS raw
FROM (SELECT conv_id, turn, text,
  CASE conv_id%7 WHEN 0 THEN '1e-7' WHEN 1 THEN '123456789.5' WHEN 2 THEN '1.5e22' WHEN 3 THEN '0.0001' WHEN 4 THEN '12' WHEN 5 THEN '2e16' ELSE '0.5' END AS raw_num,
  replace(replace(replace(text,chr(92),concat(chr(92),chr(92))),chr(34),concat(chr(92),chr(34))),chr(10),concat(chr(92),'n')) AS t
  FROM {conversations}) c""",
    "responses": """
SELECT concat('m',conv_id%3) AS model_id, conv_id AS batch_id, turn,
 cast(length(text)-length(replace(text,' ',''))+1 AS bigint) AS tokens_used,
 cast(length(text)%500+1 AS bigint) AS elapsed_ms
FROM {conversations} WHERE role='assistant'""",
    "eval_results": """
SELECT concat('org/a-rather-long-model-name-to-be-cut-',user_id) AS model_id, event_type AS dataset, count(*) AS n_samples,
 cast(sum(cast(round(value*100) AS bigint)) AS double)/count(*)/50000e0 AS avg_rouge1, max(value)/500e0 AS avg_bertscore, min(value)/500e0 AS avg_faithfulness,
 CASE WHEN user_id%10=0 THEN NULL ELSE 5e0 END AS avg_judge_score
FROM {events} GROUP BY user_id,event_type""",
    "history": """
SELECT user_id AS loop_id, event_id AS iteration, value/500e0 AS avg_rouge1,
 CASE WHEN event_type='error' THEN 0 ELSE 1 END AS n_gaps, CASE WHEN event_type='signup' THEN 0 ELSE 10 END AS n_syn
FROM {events}""",
}

# Whole tensors, one array per row; chunking and unnesting differ by engine.
_TENSORS = """
SELECT concat('m',vec_id%4) AS model_id,
 CASE t%10 WHEN 0 THEN concat('model.embed_tokens.',t,'.weight')
  WHEN 1 THEN concat('model.layers.',t,'.self_attn.q_proj.weight') WHEN 2 THEN concat('model.layers.',t,'.mlp.up_proj.weight')
  WHEN 3 THEN concat('model.layers.',t,'.post_attention_layernorm.weight') WHEN 4 THEN concat('lm_head.',t,'.weight')
  WHEN 5 THEN concat('model.norm.',t,'.weight') ELSE concat('extra.',t,'.bias') END AS tensor,
 t AS ordinal, CASE WHEN label=9 THEN 'BF16' ELSE 'F32' END AS dtype,
 {values} AS vals
FROM (SELECT vec_id, label, embedding, cast(floor(vec_id/4e0) AS bigint) AS t FROM {embeddings}) e
WHERE NOT (vec_id%4=3 AND label=9)"""
_SPARK_VALUES = "CASE WHEN vec_id%4=2 AND label=7 THEN slice(embedding,1,60) WHEN t%50=7 THEN slice(embedding,1,0) ELSE embedding END"
_DUCK_VALUES = "CASE WHEN vec_id%4=2 AND label=7 THEN embedding[1:60] WHEN t%50=7 THEN embedding[1:0] ELSE embedding END"

FIXTURE_CHUNK = 16

DUCK_ONLY = {
    "probe_losses": """
SELECT m.model_id, q.probe, CASE WHEN m.tags IS NULL AND q.probe=2 THEN NULL
  ELSE ((m.ord*13+q.probe*7)%50)/10e0 END AS loss
FROM {models} m CROSS JOIN (SELECT 0 AS probe UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) q""",
    "tensors": f"""
SELECT model_id, tensor, ordinal, dtype, len(vals) AS numel FROM ({_TENSORS.replace('{values}', _DUCK_VALUES)})""",
    "params": f"""
SELECT model_id, tensor, len(vals) AS numel, unnest(range(len(vals))) AS idx, unnest(vals) AS value
FROM ({_TENSORS.replace('{values}', _DUCK_VALUES)})""",
    "token_vecs": """
SELECT t.model_id, t.sample_id, t.side, t.pos, e.embedding AS vec FROM (
 SELECT CASE WHEN other THEN 'm9' ELSE model_id END AS model_id, sample_id, side, pos,
  (ord*CASE side WHEN 'pred' THEN 3 ELSE 5 END+pos+CASE WHEN other THEN 7 ELSE 0 END)%(SELECT count(*) FROM {embeddings}) AS vec_id
 FROM {samples}, (VALUES (false),(true)) o(other), (VALUES ('pred',6),('ref',5)) s(side,n), range(6) r(pos)
 WHERE pos<n AND NOT (side='ref' AND ord%13=0) AND NOT (side='pred' AND ord%17=0)) t
JOIN {embeddings} e ON e.vec_id=t.vec_id""",
    "adapter_a": """
SELECT concat('w',label//5) AS tensor, label%5 AS r, col, avg(v) AS value
FROM (SELECT label, unnest(range(len(embedding))) AS col, unnest(embedding) AS v FROM {embeddings}) GROUP BY ALL""",
    "adapter_b": """
SELECT concat('w',label//5) AS tensor, vec_id AS row, label%5 AS r, embedding[label+1] AS value FROM {embeddings}""",
    "synthetic": """
SELECT ord AS row_ord, context, question, CASE WHEN judge_raw IS NULL THEN '' ELSE prediction END AS answer,
 CASE (ord//100)%2 WHEN 0 THEN 'numerical' ELSE 'factual_recall' END AS gap_cat FROM {samples}""",
}


DUCK_ONLY |= {
    "keyword_table": """
SELECT left(keyword,1) AS category, CAST(length(keyword) AS INTEGER) AS kw_ord, keyword FROM (
 SELECT DISTINCT unnest(string_split_regex(lower(text),'[^a-z]+')) AS keyword FROM {documents}) WHERE keyword<>''""",
    "gap_keywords": """
SELECT * FROM (SELECT DISTINCT CAST(item_id%20 AS INTEGER) AS cat_ord, concat('topic ',item_id%20) AS gap_cat,
 unnest(string_split_regex(lower(text),'[^a-z]+')) AS keyword FROM {benchmark}) WHERE keyword<>''""",
}


class _Deps(dict):
    def __init__(self, resolve):
        super().__init__()
        self._resolve = resolve

    def __missing__(self, name):
        self[name] = self._resolve(name)
        return self[name]


def _names_in(template: str) -> list[str]:
    from string import Formatter

    return sorted({field for _, field, _, _ in Formatter().parse(template) if field})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a lazy DataFrame."""
    if name in NAMES:
        return table(spark, sf_dir, name)
    if name in _BUILT:
        return _BUILT[name](spark, sf_dir)
    return _from_sql(spark, sf_dir, VIEWS[name])


def _from_sql(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    deps = {n: view(spark, sf_dir, n) for n in _names_in(template)}
    return spark.sql(template, **deps)


def _words() -> Column:
    return F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("keyword")


def _keyword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents as a keyword, by its first letter."""
    words = table(spark, sf_dir, "documents").select(_words()).distinct().filter("keyword <> ''")
    return words.select(F.left("keyword", F.lit(1)).alias("category"), F.length("keyword").alias("kw_ord"), "keyword")


def _gap_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty topics, each with the words of some benchmark items."""
    topic = F.col("item_id") % 20
    return (
        table(spark, sf_dir, "benchmark")
        .select(topic.cast("int").alias("cat_ord"), F.concat(F.lit("topic "), topic).alias("gap_cat"), _words())
        .distinct()
        .filter("keyword <> ''")
    )


def _params(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = _from_sql(spark, sf_dir, _TENSORS.replace("{values}", _SPARK_VALUES))
    return chunked(
        whole.select(
            "model_id",
            "tensor",
            "ordinal",
            "dtype",
            F.array(F.size("vals").cast("bigint")).alias("shape"),
            "vals",
        ),
        "vals",
        FIXTURE_CHUNK,
    )


def _token_vecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of the answers of their model and, over the same samples, of model m9."""
    vectors = table(spark, sf_dir, "embeddings")
    cells = [
        F.struct(F.lit(other).alias("other"), F.lit(side).alias("side"), F.lit(pos).cast("bigint").alias("pos"))
        for other in (False, True)
        for side, n in (("pred", 6), ("ref", 5))
        for pos in range(n)
    ]
    places = view(spark, sf_dir, "samples").select(
        "model_id", "sample_id", "ord", F.inline(F.array(*cells))
    )
    there = F.when(F.col("side") == "ref", F.col("ord") % 13 != 0).otherwise(F.col("ord") % 17 != 0)
    step = F.when(F.col("side") == "pred", 3).otherwise(5)
    place = F.col("ord") * step + F.col("pos") + F.when(F.col("other"), 7).otherwise(0)
    return (
        places.filter(there)
        .withColumn("vec_id", place % F.lit(vectors.count()))
        .join(vectors.select("vec_id", F.col("embedding").alias("vec")), "vec_id")
        .select(
            F.when(F.col("other"), "m9").otherwise(F.col("model_id")).alias("model_id"),
            "sample_id",
            "side",
            "pos",
            "vec",
        )
    )


def _matrix() -> Column:
    """Labels 0-4 form one matrix, 5-9 another; the label is also the rank."""
    return F.concat(F.lit("w"), F.expr("label div 5"))


def _adapter_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-rank side A: one row per rank, the mean vector of that label."""
    entries = table(spark, sf_dir, "embeddings").select(
        _matrix().alias("tensor"), F.expr("label % 5").alias("r"), F.posexplode("embedding").alias("col", "v")
    )
    return entries.groupBy("tensor", "r", "col").agg(F.avg("v").alias("value"))


def _adapter_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-rank side B: each output row loads on the rank of its own label."""
    return table(spark, sf_dir, "embeddings").select(
        _matrix().alias("tensor"),
        F.col("vec_id").alias("row"),
        F.expr("label % 5").alias("r"),
        F.get("embedding", F.col("label")).alias("value"),
    )


def _probe_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("tags").isNull() & (F.col("probe") == 2)
    return view(spark, sf_dir, "models").select(
        "model_id", "ord", "tags", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("probe")
    ).select(
        "model_id",
        "probe",
        F.when(~failed, F.expr("((ord * 13 + probe * 7) % 50) / 10D")).alias("loss"),
    )


def _synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "samples").select(
        F.col("ord").alias("row_ord"),
        "context",
        "question",
        F.when(F.col("judge_raw").isNull(), "").otherwise(F.col("prediction")).alias("answer"),
        F.when(F.expr("(ord div 100) % 2 = 0"), "numerical")
        .otherwise("factual_recall")
        .alias("gap_cat"),
    )


_BUILT = {
    "params": _params,
    "token_vecs": _token_vecs,
    "adapter_a": _adapter_a,
    "adapter_b": _adapter_b,
    "synthetic": _synthetic,
    "probe_losses": _probe_losses,
    "keyword_table": _keyword_table,
    "gap_keywords": _gap_keywords,
}


def duck(names: str, body: str) -> str:
    """DuckDB text with the named views (and what they need) as leading CTEs."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in NAMES or name in order:
            return
        for dep in _names_in(_duck_template(name)):
            need(dep)
        order.append(name)

    for name in names.split():
        need(name)
    ctes = [f"{n} AS ({_duck_template(n).format_map(_Deps(lambda d: d))})" for n in order]
    body = body.strip()
    if body[:5].upper() == "WITH ":
        recursive = body[5:15].upper() == "RECURSIVE "
        body = body[15:] if recursive else body[5:]
        return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + ",\n" + body
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def _duck_template(name: str) -> str:
    return DUCK_ONLY.get(name) or VIEWS[name]
