"""Parameter and merging queries, results exploded to elements for the check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.operators import merging as G
from modelyard.operators import parameters as P
from modelyard.sources.views import duck, view

BASE, MODELS = "m0", ["m1", "m2", "m3"]
WEIGHTS = [0.5, 0.25, 2.0]


def _params(spark, sf):
    return view(spark, sf, "params")


def _rows(chunks, *keys):
    keys = keys or ("tensor",)
    return P.elements(chunks, *keys).select(
        *keys, "idx", F.round(F.col("value").cast("double"), 6).alias("value")
    )


def _elected(spark, sf):
    return P.elements(G.elected(_params(spark, sf), BASE, MODELS), "tensor").select(
        "tensor", "idx", F.col("value").cast("double").alias("elected")
    )


def _low_rank(spark, sf):
    """Two matrices: a row per vector; 64 columns in four column chunks."""
    width = 16
    vectors = view(spark, sf, "embeddings")
    weight = vectors.select(
        F.concat(F.lit("w"), F.expr("label div 5")).alias("tensor"),
        F.col("vec_id").alias("row"),
        F.posexplode(
            F.array(*[F.slice("embedding", c * width + 1, width) for c in range(64 // width)])
        ).alias("chunk", "values"),
    ).withColumn("start", F.col("chunk").cast("bigint") * width)
    side_a = (
        view(spark, sf, "adapter_a")
        .groupBy("tensor", "r", F.floor(F.col("col") / width).cast("int").alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("col", "value"))).alias("cells"))
        .select("tensor", "r", "chunk", F.col("cells.value").alias("values"))
    )
    side_b = view(spark, sf, "adapter_b").select(
        "tensor",
        "row",
        F.array(*[F.when(F.col("r") == i, F.col("value")).otherwise(0.0) for i in range(5)]).alias(
            "factors"
        ),
    )
    merged = G.merge_low_rank(weight, side_a, side_b, rank=5, alpha=32)
    return P.elements(merged, "tensor", "row").select(
        "tensor", "row", "idx", F.round(F.col("value").cast("double"), 6).alias("value")
    )


QUERIES = {
    "IO9_parameter_source": lambda s, d: P.elements(_params(s, d)).select(
        "model_id", "tensor", "idx", F.col("value").cast("double").alias("value")
    ),
    "M1_layer_kind": lambda s, d: P.tensors(_params(s, d)).select("model_id", "tensor", "kind"),
    "M2_architecture": lambda s, d: P.architecture(_params(s, d)),
    "M3_architecture_tree": lambda s, d: P.architecture_listing(_params(s, d)).withColumn(
        "params_m", F.round("params_m", 6)
    ),
    "M4_layer_groups": lambda s, d: P.layer_groups(_params(s, d)),
    "M5_delta": lambda s, d: _rows(
        reduce(DataFrame.unionByName, [P.delta(_params(s, d), BASE, m) for m in MODELS]), "model_id", "tensor"
    ),
    "M6_slerp": lambda s, d: _rows(G.slerp(_params(s, d), "m1", "m2", 0.3)),
    "M7_task_arithmetic": lambda s, d: _rows(G.task_arithmetic(_params(s, d), BASE, MODELS)),
    "M8_trim_by_magnitude": lambda s, d: _rows(
        G.trimmed_rows(_params(s, d), BASE, MODELS, 0.7), "model_id", "tensor"
    ),
    "M9_sign_election": _elected,
    "M10_ties": lambda s, d: _rows(G.ties(_params(s, d), BASE, MODELS)),
    "M11_breadcrumbs": lambda s, d: _rows(G.breadcrumbs(_params(s, d), BASE, MODELS)),
    "M12_bfloat16": lambda s, d: P.elements(P.to_bfloat16(_params(s, d))).select(
        "model_id", "tensor", "idx", F.col("value").cast("double").alias("value")
    ),
    "M13_dare_ties": lambda s, d: _rows(G.dare_ties(_params(s, d), BASE, MODELS, seed=7)),
    "M14_merge_dispatch": lambda s, d: _rows(
        G.merge_models(_params(s, d), "ties", ["m1", "m2", "m3"], base_model=BASE)
    ),
    "M14_merge_weights": lambda s, d: _rows(
        G.merge_models(_params(s, d), "task_arithmetic", MODELS, base_model=BASE, weights=WEIGHTS)
    ),
    "M15_equal_weights": lambda s, d: _rows(
        G.task_arithmetic(_params(s, d), BASE, MODELS, weights=G.equal_weights(MODELS))
    ),
    "M16_low_rank_merge": _low_rank,
}

_SHAPES = "sizes AS (SELECT * FROM tensors)"
_KIND = """CASE WHEN regexp_matches(lower({0}),'embed_tokens|wte|word_embeddings') THEN 'embedding'
 WHEN regexp_matches(lower({0}),'self_attn|attention|attn|q_proj|k_proj|v_proj|o_proj') THEN 'attention'
 WHEN regexp_matches(lower({0}),'mlp|ffn|feed_forward|gate_proj|up_proj|down_proj|fc1|fc2') THEN 'mlp'
 WHEN regexp_matches(lower({0}),'norm') THEN 'norm' WHEN regexp_matches(lower({0}),'lm_head|embed_out|output') THEN 'head' ELSE 'other' END"""
_ARCH = f"""arch AS (
 SELECT model_id, 0 AS depth, '' AS parent, model_id AS name, 'root' AS kind, CAST(sum(numel) AS BIGINT) AS numel, min(ordinal) AS ordinal, NULL AS shape, NULL AS dtype FROM sizes GROUP BY model_id
 UNION ALL SELECT model_id, 1, model_id, split_part(tensor,'.',1) AS top, {_KIND.format("split_part(tensor,'.',1)")}, CAST(sum(numel) AS BIGINT), min(ordinal), NULL, NULL FROM sizes GROUP BY model_id, top
 UNION ALL SELECT model_id, 2, split_part(tensor,'.',1), tensor, {_KIND.format("tensor")}, numel, ordinal, '['||numel||']', dtype FROM sizes)"""
_DELTA = """d AS (SELECT f.model_id, f.tensor, f.idx, f.value-b.value AS d FROM params f JOIN params b ON b.model_id='m0'
 AND f.tensor=b.tensor AND f.idx=b.idx AND f.numel=b.numel WHERE f.model_id<>'m0')"""
_TRIM = (
    _DELTA
    + """, t AS (SELECT model_id, tensor, idx, CASE WHEN abs(d)<th THEN 0::FLOAT ELSE d END AS d FROM (SELECT *, min(CASE WHEN rn<=k THEN abs(d) END) OVER (PARTITION BY model_id,tensor) AS th
 FROM (SELECT *, row_number() OVER (PARTITION BY model_id,tensor ORDER BY abs(d) DESC) AS rn,
  greatest(1,CAST(floor(count(*) OVER (PARTITION BY model_id,tensor)*0.7e0) AS BIGINT)) AS k FROM d)))"""
)
_BASE = "b AS (SELECT tensor, idx, value FROM params WHERE model_id='m0')"
_ELECT = """e AS (SELECT tensor, idx, CASE WHEN sum(sign(d))<0 THEN -1e0 ELSE 1e0 END AS elected FROM t GROUP BY tensor, idx)"""
_MERGE = """m AS (SELECT t.tensor, t.idx, coalesce(avg(CASE WHEN sign(d)=elected THEN CAST(d AS DOUBLE) END),0) AS md
 FROM t JOIN e ON t.tensor=e.tensor AND t.idx=e.idx GROUP BY t.tensor, t.idx)"""
_OUT = """SELECT b.tensor, b.idx, round(CAST(CAST(b.value+0.5e0*coalesce(md,0) AS FLOAT) AS DOUBLE),6) AS value
 FROM b LEFT JOIN m ON b.tensor=m.tensor AND b.idx=m.idx"""
_TIES = f"WITH {_TRIM}, {_ELECT}, {_MERGE}, {_BASE} {_OUT}"


def _sum_sql(weight: str) -> str:
    return f"""WITH {_DELTA}, m AS (SELECT tensor, idx, sum({weight}*CAST(d AS DOUBLE)) AS md FROM d GROUP BY tensor, idx), {_BASE} {_OUT}"""


_DRAW = """x0 AS (SELECT *, (CAST('0x'||left(md5('7:'||model_id||':'||tensor),8) AS BIGINT)+(idx%2147483648)*2654435761+idx//2147483648)%4294967296 AS x FROM d),
x1 AS (SELECT * REPLACE ((xor(x,x>>16)*73244475)%4294967296 AS x) FROM x0),
x2 AS (SELECT * REPLACE ((xor(x,x>>16)*73244475)%4294967296 AS x) FROM x1),
t AS (SELECT model_id, tensor, idx, CASE WHEN xor(x,x>>16)<CAST(trunc(0.7e0*4294967296) AS BIGINT) THEN CAST(CAST(d AS DOUBLE)/0.7e0 AS FLOAT) ELSE 0::FLOAT END AS d FROM x2)"""

ORACLE = {
    "IO9_parameter_source": duck(
        "params", "SELECT model_id, tensor, idx, CAST(value AS DOUBLE) AS value FROM params"
    ),
    "M1_layer_kind": duck(
        "tensors", f"WITH {_SHAPES} SELECT model_id, tensor, {_KIND.format('tensor')} AS kind FROM sizes"
    ),
    "M2_architecture": duck("tensors", f"WITH {_SHAPES}, {_ARCH} SELECT * FROM arch"),
    "M3_architecture_tree": duck(
        "tensors",
        f"WITH {_SHAPES}, {_ARCH} SELECT model_id, depth, ordinal, name, kind, shape, dtype, round(numel/1e6,6) AS params_m FROM arch",
    ),
    "M4_layer_groups": duck(
        "tensors", f"WITH {_SHAPES} SELECT model_id, {_KIND.format('tensor')} AS kind, tensor FROM sizes"
    ),
    "M5_delta": duck(
        "params",
        f"WITH {_DELTA} SELECT model_id, tensor, idx, round(CAST(d AS DOUBLE),6) AS value FROM d",
    ),
    "M6_slerp": duck(
        "params",
        """WITH p AS (SELECT a.tensor, a.idx, CAST(a.value AS DOUBLE) AS x, CAST(b.value AS DOUBLE) AS y, a.value AS keep
 FROM (SELECT * FROM params WHERE model_id='m1') a LEFT JOIN (SELECT * FROM params WHERE model_id='m2') b
 ON a.tensor=b.tensor AND a.idx=b.idx AND a.numel=b.numel),
g AS (SELECT tensor, sqrt(sum(x*x)) AS n0, sqrt(sum(y*y)) AS n1, sum(x*y) AS xy FROM p WHERE y IS NOT NULL GROUP BY tensor),
h AS (SELECT tensor, CASE WHEN n0>=1e-8 AND n1>=1e-8 THEN acos(greatest(-1,least(1,xy/(n0*n1)))) END AS th FROM g)
SELECT p.tensor, p.idx, round(CAST(CAST(CASE WHEN y IS NULL THEN x WHEN th IS NULL OR abs(th)<1e-6 THEN 0.7e0*x+0.3e0*y
 ELSE sin(0.7e0*th)/sin(th)*x+sin(0.3e0*th)/sin(th)*y END AS FLOAT) AS DOUBLE),6) AS value FROM p LEFT JOIN h ON p.tensor=h.tensor""",
    ),
    "M7_task_arithmetic": duck("params", _sum_sql("1e0")),
    "M8_trim_by_magnitude": duck(
        "params",
        f"WITH {_TRIM} SELECT model_id, tensor, idx, round(CAST(d AS DOUBLE),6) AS value FROM t",
    ),
    "M9_sign_election": duck(
        "params",
        f"WITH {_TRIM}, {_ELECT}, {_BASE} SELECT b.tensor, b.idx, coalesce(elected,1e0) AS elected FROM b LEFT JOIN e ON b.tensor=e.tensor AND b.idx=e.idx",
    ),
    "M10_ties": duck("params", _TIES),
    "M11_breadcrumbs": duck(
        "params",
        f"""WITH {_DELTA}, m AS (SELECT tensor, idx, CASE WHEN min(sign(d))=max(sign(d)) AND abs(avg(CAST(d AS DOUBLE)))>=0.01
 THEN avg(CAST(d AS DOUBLE)) ELSE 0 END AS md FROM d GROUP BY tensor, idx), {_BASE} {_OUT.replace('0.5e0*','')}""",
    ),
    "M12_bfloat16": duck(
        "params",
        """WITH q AS (SELECT *, pow(2e0, floor(log2(abs(CAST(value AS DOUBLE))))-7) AS u FROM params)
SELECT model_id, tensor, idx, CAST(CAST(CASE WHEN value=0 THEN 0 ELSE round_even(CAST(value AS DOUBLE)/u,0)*u END AS FLOAT) AS DOUBLE) AS value FROM q""",
    ),
    "M13_dare_ties": duck(
        "params", f"WITH {_DELTA}, {_DRAW}, {_ELECT}, {_MERGE}, {_BASE} {_OUT}"
    ),
    "M14_merge_dispatch": duck("params", _TIES),
    "M14_merge_weights": duck(
        "params", _sum_sql("(CASE model_id WHEN 'm1' THEN 0.5e0 WHEN 'm2' THEN 0.25e0 ELSE 2e0 END)")
    ),
    "M15_equal_weights": duck("params", _sum_sql("(1e0/3)")),
    "M16_low_rank_merge": duck(
        "adapter_a adapter_b",
        """WITH w AS (SELECT concat('w',label//5) AS tensor, vec_id AS row, unnest(range(len(embedding))) AS idx, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT w.tensor, w.row, w.idx, round(CAST(CAST(v+32e0/5*coalesce(a.value*CAST(b.value AS DOUBLE),0) AS FLOAT) AS DOUBLE),6) AS value
FROM w LEFT JOIN adapter_b b ON b.row=w.row LEFT JOIN adapter_a a ON a.tensor=b.tensor AND a.r=b.r AND a.col=w.idx""",
    ),
}
