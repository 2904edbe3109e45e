"""Discovery queries over the derived registry, each with its check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelyard.operators import discovery as D
from modelyard.operators import keywords as I
from modelyard.operators import registry_state as Q
from modelyard.session import settled
from modelyard.sources.views import CATEGORIES, duck, view

def _models(spark, sf):
    return view(spark, sf, "models")


def _found(spark, sf):
    return D.scan_registry(_models(spark, sf), CATEGORIES)


def _scored(spark, sf):
    return D.scored(D.with_card_quality(settled(_found(spark, sf)), view(spark, sf, "cards")))


def _blended(spark, sf):
    candidates = settled(_scored(spark, sf))
    probes = D.probes_of_leading(candidates, view(spark, sf, "probe_losses"))
    return D.blend_perplexity(candidates, D.perplexity(probes))


def _all(spark, sf, ppl=True):
    return D.discover(
        _models(spark, sf),
        view(spark, sf, "cards"),
        view(spark, sf, "probe_losses") if ppl else None,
        CATEGORIES,
    )


def _from_state(spark, sf):
    """The search's result from a state over yesterday's registry and what changed since.

    Yesterday one brand was not there, another had twice the downloads and one more task.
    """
    today = _models(spark, sf)
    brand = F.substring_index("model_id", "/", 1)
    double = F.when(brand == "brand3", F.col("downloads") * 2).otherwise(F.col("downloads"))
    task = F.when(brand == "brand3", "text-generation").otherwise(F.col("task"))
    yesterday = today.filter(brand != "brand4").withColumn("downloads", double).withColumn("task", task)
    state = Q.state_of(D.matching_keywords(yesterday, CATEGORIES))
    change = today.filter(brand.isin("brand3", "brand4"))
    state = Q.updated(state, change, D.matching_keywords(change, CATEGORIES))
    return Q.top(Q.refreshed(state, D.matching_keywords(today, CATEGORIES))).select(
        "category", "kw_ord", "keyword", "rank", "model_id", "downloads"
    )


_KEYS = ["category", "model_id", "kw_ord", "rank"]

QUERIES = {
    "D1_category_dimension": lambda s, d: D.keyword_coverage(_models(s, d), CATEGORIES),
    "D2_keyword_top_n": lambda s, d: D.search_by_keyword(_models(s, d), CATEGORIES).select(
        "category", "kw_ord", "keyword", "rank", "model_id", "downloads"
    ),
    "D2_keyword_index": lambda s, d: I.search(_models(s, d), view(s, d, "keyword_table")).select(
        "category", "keyword", "rank", "model_id", "downloads"
    ),
    "D2_registry_state": _from_state,
    "D3_first_seen": lambda s, d: D.first_seen(
        D.search_by_keyword(_models(s, d), CATEGORIES)
    ).select(*_KEYS),
    "D4_quality_gate": lambda s, d: D.quality_gate(_models(s, d)).select(
        "model_id", "downloads", "likes"
    ),
    "D5_size_from_tags": lambda s, d: _models(s, d).select(
        "model_id", D.size_from_tags(F.col("tags")).alias("params_b")
    ),
    "D6_size_from_id": lambda s, d: _models(s, d).select(
        "model_id", D.size_from_id(F.col("model_id")).alias("params_b")
    ),
    "D7_size_gate": lambda s, d: D.size_gate(D.with_params(_models(s, d))).select(
        "model_id", "params_b"
    ),
    "D8_candidates": lambda s, d: _found(s, d).withColumn("tags", F.array_join("tags", ",")),
    "D9_card_completeness": lambda s, d: _models(s, d)
    .select("model_id")
    .join(D.card_completeness(view(s, d, "cards")), "model_id", "left")
    .select("model_id", F.round(F.coalesce("card_quality", F.lit(0.0)), 6).alias("card_quality")),
    "D10_composite_score": lambda s, d: _scored(s, d).select(
        "category", "model_id", F.round("score", 6).alias("score")
    ),
    "D11_perplexity": lambda s, d: D.perplexity(view(s, d, "probe_losses")).select(
        "model_id", F.round("ppl", 6).alias("ppl")
    ),
    "D12_perplexity_blend": lambda s, d: _blended(s, d).select(
        "category", "model_id", F.round("score", 6).alias("score"), "notes"
    ),
    "D13_top_k": lambda s, d: D.top_candidates(_scored(s, d)).select(
        "category", "place", "model_id", F.round("score", 6).alias("score")
    ),
    "D14_all_categories": lambda s, d: _all(s, d).select(
        "category", "place", "model_id", F.round("score", 6).alias("score"), "notes"
    ),
    "D15_ranked_report": lambda s, d: D.ranked_report(_all(s, d)),
    "IO1_models_source": lambda s, d: _models(s, d)
    .filter(F.col("task") == "text-generation")
    .select("model_id", "downloads", "likes", "pipeline_tag"),
}

_KW = """kw AS (SELECT * FROM (VALUES ('code',0,'ring'),('code',1,'gear'),('reasoning',0,'bolt'),('reasoning',1,'ring'),
 ('reasoning',2,'hot'),('chat',0,'anvil'),('none',0,'zzz')) v(category,kw_ord,keyword))"""
_HITS = _KW + """, hits AS (SELECT * FROM (SELECT k.*, m.*, CAST(row_number() OVER (PARTITION BY category,kw_ord
  ORDER BY coalesce(downloads,0) DESC, model_id) AS INTEGER) AS rank
 FROM models m JOIN kw k ON contains(lower(m.model_id),lower(k.keyword)) WHERE task='text-generation') WHERE rank<=50)"""
_FIRST = _HITS + """, firsts AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY category,model_id
 ORDER BY kw_ord,rank) AS rn FROM hits) WHERE rn=1)"""
_NUM = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?$"
_TAG_SIZE = f"""(SELECT v FROM (SELECT tag_i, s_i, TRY_CAST(CASE WHEN regexp_matches(c,'{_NUM}') THEN c END AS DOUBLE) AS v FROM (
   SELECT tag_i, s_i, split_part(left(tag, pos-1),'-',-1) AS c FROM (
    SELECT tag_i, s_i, tag, length(tag)-length(suf)+2-strpos(reverse(tag),reverse(suf)) AS pos, strpos(reverse(tag),reverse(suf)) AS p0
    FROM (SELECT unnest(range(len(tags))) AS tag_i, unnest(list_transform(tags, lambda x: lower(x))) AS tag) t
    CROSS JOIN (VALUES (0,'b'),(1,'b-instruct'),(2,'b-chat')) sx(s_i,suf))
   WHERE p0>0 AND pos>1)) WHERE v IS NOT NULL ORDER BY tag_i, s_i LIMIT 1)"""
_ID_SIZE = f"""(SELECT v FROM (SELECT i, TRY_CAST(CASE WHEN regexp_matches(left(tok,length(tok)-1),'{_NUM}') THEN left(tok,length(tok)-1) END AS DOUBLE) AS v
  FROM (SELECT unnest(range(len(toks))) AS i, unnest(toks) AS tok FROM (SELECT regexp_split_to_array(replace(replace(lower(model_id),'-',' '),'_',' '),'\\s+') AS toks))
  WHERE tok LIKE '%b') WHERE v IS NOT NULL ORDER BY i LIMIT 1)"""
_SIZED = f"sized AS (SELECT *, coalesce({_TAG_SIZE},{_ID_SIZE},0.0) AS params_b FROM "
_FOUND = (
    _FIRST
    + ", gated AS (SELECT * REPLACE (coalesce(downloads,0) AS downloads, coalesce(likes,0) AS likes) FROM firsts"
    + " WHERE coalesce(downloads,0)>=1000 AND coalesce(likes,0)>=10), "
    + _SIZED
    + """gated), found AS (SELECT category, model_id, downloads, likes, params_b,
 coalesce(nullif(pipeline_tag,''),'text-generation') AS pipeline_tag, coalesce(tags,[]) AS tags, kw_ord, rank FROM sized WHERE NOT (params_b>10 AND params_b<>0))"""
)
_CARDQ = """quality AS (SELECT model_id, (CAST(contains(lower(card_text),'## model details') AS INT)+CAST(contains(lower(card_text),'## intended uses') AS INT)
 +CAST(contains(lower(card_text),'## training') AS INT)+CAST(contains(lower(card_text),'## evaluation') AS INT)
 +CAST(contains(lower(card_text),'## limitations') AS INT))/5e0 AS card_quality FROM cards)"""
_SCORED = (
    _FOUND
    + ", "
    + _CARDQ
    + """, scored AS (SELECT *, 0.4e0*log10(greatest(downloads,1))/8+0.2e0*log10(greatest(likes,1))/5+0.2e0*card_quality
 +0.2e0*(CASE WHEN params_b=0 THEN 0.3e0 ELSE greatest(0e0,1-abs(params_b-7)/7) END) AS score
 FROM (SELECT f.*, coalesce(q.card_quality,0) AS card_quality FROM found f LEFT JOIN quality q USING (model_id)))"""
)
_PPL = """ppls AS (SELECT model_id, CASE WHEN count(loss)=4 AND count(*)=4 THEN avg(exp(loss)) END AS ppl FROM probe_losses GROUP BY model_id)"""
_BLEND = (
    _SCORED
    + ", "
    + _PPL
    + """, placed AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY score DESC,kw_ord,rank) AS pl FROM scored),
blended AS (SELECT p.* REPLACE (CASE WHEN pl<=10 AND ppl IS NOT NULL THEN 0.7e0*score+0.3e0*greatest(0,1-(ppl-5)/100) ELSE score END AS score),
 CASE WHEN pl<=10 AND ppl IS NOT NULL THEN 'ppl='||printf('%.1f',ppl) ELSE '' END AS notes FROM placed p LEFT JOIN ppls USING (model_id)),
final AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY score DESC,kw_ord,rank) AS INTEGER) AS place FROM blended) WHERE place<=5)"""
)

ORACLE = {
    "D1_category_dimension": duck(
        "models",
        f"""WITH {_KW} SELECT category, kw_ord, keyword, (SELECT count(*) FROM models m WHERE task='text-generation'
 AND contains(lower(model_id),lower(keyword))) AS n_models FROM kw""",
    ),
    "D2_keyword_top_n": duck(
        "models", f"WITH {_HITS} SELECT category, kw_ord, keyword, rank, model_id, downloads FROM hits"
    ),
    "D2_keyword_index": duck(
        "models keyword_table",
        """SELECT category, keyword, rank, model_id, downloads FROM (SELECT *, CAST(row_number() OVER (PARTITION BY keyword
  ORDER BY coalesce(downloads,0) DESC, model_id) AS INTEGER) AS rank
 FROM models m JOIN keyword_table k ON contains(lower(m.model_id),k.keyword) WHERE task='text-generation') WHERE rank<=50""",
    ),
    "D3_first_seen": duck(
        "models", f"WITH {_FIRST} SELECT category, model_id, kw_ord, rank FROM firsts"
    ),
    "D4_quality_gate": duck(
        "models",
        "SELECT model_id, downloads, likes FROM models WHERE downloads>=1000 AND likes>=10",
    ),
    "D5_size_from_tags": duck("models", f"SELECT model_id, {_TAG_SIZE} AS params_b FROM models"),
    "D6_size_from_id": duck("models", f"SELECT model_id, {_ID_SIZE} AS params_b FROM models"),
    "D7_size_gate": duck(
        "models",
        f"WITH {_SIZED} models) SELECT model_id, params_b FROM sized WHERE params_b<=10 OR params_b=0",
    ),
    "D8_candidates": duck(
        "models", f"WITH {_FOUND} SELECT * REPLACE (array_to_string(tags,',') AS tags) FROM found"
    ),
    "D9_card_completeness": duck(
        "models cards",
        f"""WITH {_CARDQ} SELECT m.model_id, round(coalesce(card_quality,0),6) AS card_quality
 FROM models m LEFT JOIN quality USING (model_id)""",
    ),
    "D10_composite_score": duck(
        "models cards", f"WITH {_SCORED} SELECT category, model_id, round(score,6) AS score FROM scored"
    ),
    "D11_perplexity": duck(
        "models probe_losses", f"WITH {_PPL} SELECT model_id, round(ppl,6) AS ppl FROM ppls"
    ),
    "D12_perplexity_blend": duck(
        "models cards probe_losses",
        f"WITH {_BLEND} SELECT category, model_id, round(score,6) AS score, notes FROM blended",
    ),
    "D13_top_k": duck(
        "models cards",
        f"""WITH {_SCORED} SELECT category, place, model_id, round(score,6) AS score FROM (SELECT *, CAST(row_number() OVER (
 PARTITION BY category ORDER BY score DESC,kw_ord,rank) AS INTEGER) AS place FROM scored) WHERE place<=5""",
    ),
    "D14_all_categories": duck(
        "models cards probe_losses",
        f"WITH {_BLEND} SELECT category, place, model_id, round(score,6) AS score, notes FROM final",
    ),
    "D15_ranked_report": duck(
        "models cards probe_losses",
        f"""WITH {_BLEND} SELECT category, place AS rank, model_id, CASE WHEN params_b=0 THEN '?' ELSE printf('%.1f',params_b) END AS params,
 format('{{:,}}',downloads) AS downloads, CAST(likes AS VARCHAR) AS likes, printf('%.2f',card_quality) AS card,
 printf('%.3f',score) AS score, notes FROM final""",
    ),
    "IO1_models_source": duck(
        "models",
        "SELECT model_id, downloads, likes, pipeline_tag FROM models WHERE task='text-generation'",
    ),
}
ORACLE["D2_registry_state"] = ORACLE["D2_keyword_top_n"]
