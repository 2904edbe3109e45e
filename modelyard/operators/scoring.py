"""Scores of single answers. Rows are keyed by (model_id, sample_id)."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, pandas_udf

from modelyard import constants as K
from modelyard.functions import text as X

log = logging.getLogger(__name__)

KEY = ["model_id", "sample_id"]
PORTION = 256  # rows of a batch whose prompts and replies a worker holds as Python strings
#: Makes a model in a worker: a function from prompts to replies.
Model = Callable[[], Callable[[list[str]], list[str]]]


# --- prompts and model calls -------------------------------------------------


def qa_prompt() -> Column:
    return X.fill(
        "Context: {context}\nQuestion: {question}\nAnswer:",
        context=F.col("context"),
        question=F.col("question"),
    )


def judge_prompt() -> Column:
    return X.fill(
        K.JUDGE_PROMPT,
        question=F.col("question"),
        reference=F.col("reference"),
        prediction=F.col("prediction"),
    )


def nli_pair() -> Column:
    """Context and prediction, each cut to the classifier's character budget."""
    return F.concat(
        F.left("context", F.lit(K.NLI_CONTEXT_CHARS)),
        F.lit(" [SEP] "),
        F.left("prediction", F.lit(K.NLI_PREDICTION_CHARS)),
    )


def _replies(call: Callable[[list[str]], list[str]], prompts: list[str]) -> list[str | None]:
    """Replies of one batch; a batch that fails is asked again one by one."""
    try:
        replies = list(call(prompts))
        if len(replies) == len(prompts):
            return [r.strip() if isinstance(r, str) else None for r in replies]
        log.warning("%d replies to %d prompts", len(replies), len(prompts))
    except Exception as err:  # the model is a user's; its failure costs its rows only
        log.warning("model call failed: %s", err)
    if len(prompts) == 1:
        return [None]
    return [_replies(call, [p])[0] for p in prompts]


def batched_call(
    rows: DataFrame,
    prompt: str,
    output: str,
    make: Model,
    batch_size: int = 4,
) -> DataFrame:
    """Run a user's model over a prompt column in batches, in the worker processes.

    ``make`` is called once per task, so a model is loaded once and reused for all
    of the task's rows. Replies are trimmed. A prompt that is null, or whose call fails,
    gets a null reply, which the scores read as neutral.
    """
    schema = T.StructType(
        [f for f in rows.schema.fields if f.name != output] + [T.StructField(output, T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        kept = [f.name for f in schema.fields if f.name != output]
        for batch in batches:
            # rows stay Arrow columns; only the prompts of one portion become Python strings
            for begin in range(0, batch.num_rows, PORTION):
                part = batch.slice(begin, PORTION)
                texts = part.column(prompt).to_pylist()
                asked = [i for i, t in enumerate(texts) if t is not None]
                replies: list[str | None] = [None] * len(texts)
                for i in range(0, len(asked), batch_size):
                    at = asked[i : i + batch_size]
                    for k, reply in zip(at, _replies(call, [texts[k] for k in at])):
                        replies[k] = reply
                columns = [part.column(n) for n in kept] + [pa.array(replies, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, output])

    return rows.mapInArrow(run, schema)


# --- n-gram and subsequence overlap ------------------------------------------


def with_tokens(samples: DataFrame, stem: bool = True) -> DataFrame:
    """Key and the token lists of both sides: ``pred`` and ``ref``."""
    pred, ref = X.tokens(F.col("prediction")), X.tokens(F.col("reference"))
    if stem:
        pred, ref = X.stems(pred), X.stems(ref)
    return samples.select(*KEY, pred.alias("pred"), ref.alias("ref"))


def rouge(samples: DataFrame, stem: bool = True, *keep: str) -> DataFrame:
    """F-measures of single tokens, token pairs and the common subsequence.

    Decided inside the row, so a scan of any size needs no shuffle. An answer
    without tokens scores 0.
    """
    sides = [F.lower(F.coalesce(c, F.lit(""))) for c in ("prediction", "reference")]
    counted = samples.withColumn("_o", X.overlap(stem)(*sides))
    n_p, n_r = F.col("_o.p"), F.col("_o.r")
    none = F.lit(0)
    return counted.select(
        *KEY,
        *keep,
        X.f_measure(F.col("_o.m1"), n_p, n_r).alias("rouge1"),
        X.f_measure(
            F.col("_o.m2"), F.greatest(n_p - 1, none), F.greatest(n_r - 1, none)
        ).alias("rouge2"),
        X.f_measure(F.col("_o.lcs"), n_p, n_r).alias("rougeL"),
    )


# --- embedding match ---------------------------------------------------------

TOKEN_BLOCK = 256
LONG = 2048  # tokens of a side; a longer answer is compared in blocks of as many


_SIDES = T.StructType([T.StructField(n, T.DoubleType()) for n in ("p", "r")])


MATCHED = 16_384  # vectors that are compared at a time, whole answers


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0.0, 1.0, norm)


def _matrix(vectors) -> np.ndarray:
    """One vector per row, from an Arrow array of lists or an iterable of arrays."""
    if isinstance(vectors, pa.Array):
        sizes = np.unique(vectors.value_lengths())
        flat = vectors.flatten()
        if len(sizes) == 1 and not vectors.null_count and not flat.null_count:
            return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
        vectors = vectors.to_pylist()
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _best(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best match of every token of either side, given as unit vectors.

    Compared block against block, so memory stays at two blocks and a value per token.
    """
    best_a, best_b = np.full(len(a), -np.inf), np.full(len(b), -np.inf)
    for i in range(0, len(a), TOKEN_BLOCK):
        for j in range(0, len(b), TOKEN_BLOCK):
            match = a[i : i + TOKEN_BLOCK] @ b[j : j + TOKEN_BLOCK].T
            rows, cols = slice(i, i + match.shape[0]), slice(j, j + match.shape[1])
            best_a[rows] = np.maximum(best_a[rows], match.max(axis=1))
            best_b[cols] = np.maximum(best_b[cols], match.max(axis=0))
    return best_a, best_b


@arrow_udf(_SIDES)
def _greedy_match(pred: pa.Array, ref: pa.Array) -> pa.Array:
    """Mean best match of the tokens of either side; 0 when a side is empty.

    The vectors of many answers become one matrix, so that a short answer costs one product.
    """
    ends = [np.concatenate([[0], np.cumsum(c.value_lengths().fill_null(0).to_numpy())]) for c in (pred, ref)]
    both = ends[0] + ends[1]
    means = np.zeros((len(pred), 2))
    begin = 0
    while begin < len(pred):
        end = max(begin + 1, int(np.searchsorted(both, both[begin] + MATCHED, "right")) - 1)
        met = [i for i in range(begin, end) if all(e[i] < e[i + 1] for e in ends)]
        if met:
            a, b = (_unit(_matrix(c[begin:end].flatten())) for c in (pred, ref))
            at, to = (e - e[begin] for e in ends)
            for i in met:
                x, y = _best(a[at[i] : at[i + 1]], b[to[i] : to[i + 1]])
                means[i] = x.mean(), y.mean()
        begin = end
    return pa.StructArray.from_arrays([pa.array(means[:, 0]), pa.array(means[:, 1])], names=["p", "r"])


@pandas_udf(T.StructType([T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("pred", "ref")]))
def _block_match(pred: pd.Series, ref: pd.Series) -> pd.DataFrame:
    """Best match of every token within two blocks."""
    return pd.DataFrame([_best(_unit(_matrix(p)), _unit(_matrix(r))) for p, r in zip(pred, ref)], columns=["pred", "ref"])


def _side(name: str, *columns: str) -> Column:
    value = F.struct(*columns) if len(columns) > 1 else F.col(columns[0])
    return F.collect_list(F.when(F.col("side") == name, value)).alias(name)


def _match_in_blocks(token_vecs: DataFrame, block: int) -> DataFrame:
    """KEY, p and r of answers of any length, compared as blocks of tokens.

    A block of one side meets every block of the other as a row of its own, so no task holds
    more than two; what leaves a pair of blocks is one value a token, and the best of a
    token's values is an aggregation. An answer of one side only has no row.
    """
    place = F.floor(F.col("pos") / block)
    sizes = token_vecs.groupBy(*KEY).agg(
        *[F.max(F.when(F.col("side") == name, place)).alias(f"{name}_last") for name in ("pred", "ref")]
    )
    other = F.sequence(F.lit(0).cast("bigint"), F.when(F.col("side") == "pred", F.col("ref_last")).otherwise(F.col("pred_last")))
    met = token_vecs.join(sizes, KEY).select(
        *KEY, "side", "pos", "vec", place.alias("own"), F.explode(other).alias("other")
    )
    pred = F.col("side") == "pred"
    pairs = (
        met.withColumn("i", F.when(pred, F.col("own")).otherwise(F.col("other")))
        .withColumn("j", F.when(pred, F.col("other")).otherwise(F.col("own")))
        .groupBy(*KEY, "i", "j")
        .agg(_side("pred", "pos", "vec"), _side("ref", "pos", "vec"))
        .select(*KEY, "pred.pos", F.col("ref.pos").alias("ref_pos"), _block_match("pred.vec", "ref.vec").alias("m"))
    )
    values = F.array(
        *[
            F.struct(F.lit(name).alias("side"), F.arrays_zip(pos.alias("pos"), F.col(f"m.{name}").alias("best")).alias("t"))
            for name, pos in (("pred", F.col("pos")), ("ref", F.col("ref_pos")))
        ]
    )
    best = (
        pairs.select(*KEY, F.inline(values))
        .select(*KEY, "side", F.inline("t"))
        .groupBy(*KEY, "side", "pos")
        .agg(F.max("best").alias("best"))
    )
    return best.groupBy(*KEY).agg(
        *[F.avg(F.when(F.col("side") == name, F.col("best"))).alias(c) for name, c in (("pred", "p"), ("ref", "r"))]
    )


def embedding_f1(token_vecs: DataFrame, baseline: float = 0.0, long: int = LONG) -> DataFrame:
    """Greedy cosine match of prediction and reference tokens, as an F1 per answer.

    Input rows are ``(model_id, sample_id, side in {pred, ref}, pos, vec)``, pos counting a
    side's tokens from 0. One scan and one shuffle bring an answer's vectors together, up to
    ``long`` tokens a side; longer answers are told by their positions and compared as blocks
    of tokens. An answer with tokens on one side only scores like no match.
    """
    beyond = token_vecs.filter(F.col("pos") >= long).select(*KEY).distinct()
    huge = not beyond.isEmpty()
    whole = token_vecs.join(beyond, KEY, "left_anti") if huge else token_vecs
    sides = (
        whole.groupBy(*KEY)
        .agg(_side("pred", "vec"), _side("ref", "vec"))
        .select(*KEY, _greedy_match("pred", "ref").alias("m"))
        .select(*KEY, "m.p", "m.r")
    )
    if huge:
        blocks = _match_in_blocks(token_vecs.join(beyond, KEY, "left_semi"), long)
        sides = sides.unionByName(beyond.join(blocks, KEY, "left"))
    p, r = F.col("p"), F.col("r")
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return sides.select(*KEY, ((f1 - baseline) / (1 - baseline)).alias("bertscore_f1"))


# --- faithfulness and judge --------------------------------------------------


def faithfulness(label: Column, score: Column) -> Column:
    """Entailment probability; a failed call (null) counts as neutral."""
    upper = F.upper(label)
    return F.coalesce(
        F.when(upper == "ENTAILMENT", score)
        .when(upper == "CONTRADICTION", 1.0 - score)
        .otherwise(F.lit(K.NEUTRAL_FAITHFULNESS)),
        F.lit(K.NEUTRAL_FAITHFULNESS),
    )


def hallucinated(prediction: Column, faith: Column) -> Column:
    return X.hallucination_words(prediction) | (faith < K.HALLUCINATED_BELOW)


def judge_score(reply: Column) -> Column:
    """First SCORE number clamped to 0..10; 5 when there is none or the call failed.

    Leading zeros aside, three digits or more are over the clamp anyway, which
    keeps arbitrarily long numbers out of the cast.
    """
    digits = F.regexp_extract(reply, r"(?U)SCORE:\s*(?-U)0*([0-9]+)", 1)
    value = F.when(F.length(digits) > 2, F.lit(10.0)).otherwise(digits.try_cast("double"))
    return F.least(F.lit(10.0), F.coalesce(value, F.lit(K.DEFAULT_JUDGE)))


def judge_reason(reply: Column) -> Column:
    return F.coalesce(
        X.strip(F.regexp_extract(reply, r"(?dU)REASON:\s*(.+)", 1)), F.lit("")
    )


def pairwise_verdict(judged: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """Compare two models' judge scores per sample; a tie goes to the first."""

    def of(model: str, name: str) -> DataFrame:
        return judged.filter(F.col("model_id") == model).select(
            "sample_id", F.col("judge_score").alias(name)
        )

    return of(model_a, "score_a").join(of(model_b, "score_b"), "sample_id").select(
        "sample_id",
        F.when(F.col("score_a") >= F.col("score_b"), model_a).otherwise(model_b).alias("winner"),
        "score_a",
        "score_b",
        F.abs(F.col("score_a") - F.col("score_b")).alias("delta"),
    )
