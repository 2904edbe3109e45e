"""Queries over generator replies and training rows with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.operators import synthetic as Y
from modelyard.session import new_shared_path
from modelyard.sources import files
from modelyard.sources.views import duck, view


def _raw(spark, sf):
    return view(spark, sf, "llm_raw")


def _syn(spark, sf):
    return view(spark, sf, "synthetic")


def _chats(spark, sf):
    return Y.chat_rows(_syn(spark, sf), "row_ord")


def _saved(spark, sf):
    path = new_shared_path(spark, "synthetic")
    files.write_synthetic(Y.synthetic_rows(_raw(spark, sf)), path)
    return path


def _custom(spark, sf):
    path = new_shared_path(spark, "custom")
    view(spark, sf, "samples").select(
        F.col("sample_id").alias("id"), "context", "question", "reference", "prediction"
    ).write.json(path)
    return files.read_custom_samples(spark, path)


QUERIES = {
    "S1_gap_prompts": lambda s, d: Y.gap_prompts(_raw(s, d).select("raw_id", "gap_cat")),
    "S2_json_extraction": lambda s, d: Y.parsed_replies(_raw(s, d)).select(
        "raw_id", F.col("items").isNotNull().alias("parsed"), "n_items"
    ),
    "S3_item_projection": lambda s, d: Y.synthetic_rows(_raw(s, d), "raw_id"),
    "S4_yield_per_gap": lambda s, d: Y.yield_per_gap(_raw(s, d)),
    "S5_chat_format": lambda s, d: _chats(s, d),
    "S6_response_mask": lambda s, d: Y.response_mask(_chats(s, d), "row_ord"),
    "S7_packing_segments": lambda s, d: Y.pack_segments(_chats(s, d), "row_ord"),
    "S7_packed_windows": lambda s, d: Y.packed_windows(_chats(s, d), "row_ord"),
    "S8_length_batches": lambda s, d: Y.length_batches(_chats(s, d), "row_ord"),
    "S9_loop_decisions": lambda s, d: Y.loop_decisions(view(s, d, "history")).withColumn(
        "best_rouge1", F.round("best_rouge1", 6)
    ),
    "IO2_qa_source": lambda s, d: files.qa_samples(
        view(s, d, "qa_raw").select(
            "ord",
            "context",
            "question",
            F.when(F.col("answer").isNull(), F.array().cast("array<string>"))
            .otherwise(F.array("answer"))
            .alias("answers"),
        )
    ),
    "IO3_custom_samples": _custom,
    "IO4_training_text_source": lambda s, d: files.read_training_text(s, _saved(s, d)),
    "IO8_synthetic_sink": lambda s, d: files.read_synthetic(s, _saved(s, d)),
}

_PARSED = r"""span AS (SELECT *, CASE WHEN json_valid(raw) THEN raw WHEN json_valid(nullif(regexp_extract(raw,'\[.*\]',0,'s'),''))
 THEN regexp_extract(raw,'\[.*\]',0,'s') END AS js FROM llm_raw),
sized AS (SELECT *, CAST(CASE json_type(js) WHEN 'ARRAY' THEN json_array_length(js) WHEN 'OBJECT' THEN len(json_keys(js)) ELSE 0 END AS INTEGER) AS n_items FROM span)"""


def _text(key: str) -> str:
    return f"""CASE json_type(it,'$.{key}') WHEN 'NULL' THEN 'None' WHEN 'BOOLEAN' THEN upper(left(it->>'$.{key}',1))||substring(it->>'$.{key}',2)

 WHEN 'DOUBLE' THEN CAST(CAST(it->>'$.{key}' AS DOUBLE) AS VARCHAR) ELSE coalesce(it->>'$.{key}','') END AS {key}"""


_ITEMS = (
    _PARSED
    + f""", items AS (SELECT raw_id, gap_cat, CAST(unnest(range(CAST(json_array_length(js) AS BIGINT))) AS INTEGER) AS pos, unnest(json_extract(js,'$[*]')) AS it FROM span WHERE json_type(js)='ARRAY'),
syn AS (SELECT raw_id, pos, {_text('context')}, {_text('question')}, {_text('answer')}, gap_cat FROM items WHERE json_type(it)='OBJECT')"""
)
_CHAT_TEXT = "'<s>[INST] Context: '||context||chr(10)||chr(10)||'Question: '||question||' [/INST] '||answer||'</s>'"
_CHATS = f"chats AS (SELECT row_ord, {_CHAT_TEXT} AS text, gap_cat FROM synthetic WHERE context<>'' AND question<>'' AND answer<>'')"
_WORDS = r"""w AS (SELECT row_ord, list_filter(regexp_split_to_array(text,'[ \t\n\r\f]+'), lambda x: x<>'') AS tokens,
 list_filter(regexp_split_to_array(substring(text, length(text)-strpos(reverse(text),reverse(' [/INST]'))+2),'[ \t\n\r\f]+'), lambda x: x<>'') AS spoken FROM chats)"""
_SEGS = """laid AS (SELECT row_ord, tokens, len(tokens) AS n, CAST(coalesce(sum(len(tokens)) OVER (ORDER BY row_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS BIGINT) AS at0 FROM w),
segs AS (SELECT row_ord, tokens, window_id, greatest(at0,window_id*2048)-at0 AS seg_from, least(at0+n,(window_id+1)*2048)-greatest(at0,window_id*2048) AS seg_len
 FROM (SELECT *, unnest(range(at0//2048,(at0+n-1)//2048+1)) AS window_id FROM laid WHERE n>0))"""
_PROMPT = "CASE gap_cat " + " ".join(
    f"WHEN '{g}' THEN '{t.replace('{n}', '50')}'" for g, t in K.GAP_PROMPTS.items()
) + f" ELSE '{K.GAP_PROMPTS[K.FALLBACK_GAP].replace('{n}', '50')}' END"

ORACLE = {
    "S1_gap_prompts": duck("llm_raw", f"SELECT raw_id, gap_cat, {_PROMPT} AS prompt FROM llm_raw"),
    "S2_json_extraction": duck(
        "llm_raw", f"WITH {_PARSED} SELECT raw_id, js IS NOT NULL AS parsed, n_items FROM sized"
    ),
    "S3_item_projection": duck("llm_raw", f"WITH {_ITEMS} SELECT * FROM syn"),
    "S4_yield_per_gap": duck(
        "llm_raw",
        f"WITH {_PARSED} SELECT gap_cat, CAST(sum(n_items) AS BIGINT) AS n_items FROM sized GROUP BY gap_cat",
    ),
    "S5_chat_format": duck("synthetic", f"WITH {_CHATS} SELECT * FROM chats"),
    "S6_response_mask": duck(
        "synthetic",
        f"""WITH {_CHATS}, {_WORDS} SELECT row_ord, CAST(pos AS INTEGER) AS pos, token, pos>=n-m AS in_loss
 FROM (SELECT row_ord, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token, len(tokens) AS n, len(spoken) AS m FROM w)""",
    ),
    "S7_packing_segments": duck(
        "synthetic",
        f"WITH {_CHATS}, {_WORDS}, {_SEGS} SELECT row_ord, window_id, seg_from, seg_len FROM segs",
    ),
    "S7_packed_windows": duck(
        "synthetic",
        f"""WITH {_CHATS}, {_WORDS}, {_SEGS} SELECT window_id, CAST(sum(seg_len) AS BIGINT) AS n_tokens,
 string_agg(array_to_string(tokens[seg_from+1:seg_from+seg_len],' '),' ' ORDER BY row_ord) AS text FROM segs GROUP BY window_id""",
    ),
    "S8_length_batches": duck(
        "synthetic",
        f"""WITH {_CHATS}, {_WORDS} SELECT row_ord, CAST(len(tokens) AS INTEGER) AS n_tokens,
 (row_number() OVER (ORDER BY len(tokens), row_ord)-1)//4 AS batch_id FROM w""",
    ),
    "S9_loop_decisions": duck(
        "history",
        """WITH r AS (SELECT *, CASE WHEN avg_rouge1>=0.45e0 THEN 'target reached' WHEN n_gaps=0 THEN 'no gaps'
  WHEN n_syn=0 THEN 'no synthetic rows' END AS reason FROM history),
s AS (SELECT loop_id, min(iteration) AS stopped_at, arg_min(reason,iteration) AS reason FROM r WHERE reason IS NOT NULL GROUP BY loop_id)
SELECT h.loop_id, max(s.stopped_at) AS stopped_at, coalesce(max(s.reason),'iterations used up') AS reason, count(*) AS iterations, round(max(h.avg_rouge1),6) AS best_rouge1
FROM history h LEFT JOIN s USING (loop_id) WHERE s.stopped_at IS NULL OR h.iteration<=s.stopped_at GROUP BY h.loop_id""",
    ),
    "IO2_qa_source": duck(
        "qa_raw",
        """SELECT CAST(ord AS VARCHAR) AS id, context, question, answer AS reference
 FROM (SELECT * FROM qa_raw ORDER BY ord LIMIT 100) WHERE answer IS NOT NULL""",
    ),
    "IO3_custom_samples": duck(
        "samples", "SELECT sample_id AS id, context, question, reference, prediction FROM samples"
    ),
    "IO4_training_text_source": duck(
        "llm_raw",
        f"WITH {_ITEMS} SELECT {_CHAT_TEXT} AS text, gap_cat FROM syn WHERE context<>'' AND question<>'' AND answer<>''",
    ),
    "IO8_synthetic_sink": duck(
        "llm_raw", f"WITH {_ITEMS} SELECT context, question, answer, gap_cat FROM syn"
    ),
}
