"""Model weights as tables.

Weights are stored chunked: one row holds a run of consecutive elements of one
tensor, ``(model_id, tensor, shape, chunk, start, values array<float>)``. A row
stays a few hundred KB however large the tensor, (tensor, chunk) is an even
shuffle key, and 4 bytes per element travel instead of a whole row. Stored tables also
carry the tensor's place in its model (``ordinal``) and its ``dtype``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.functions import kernels as N

CHUNK = 65_536
STORED = ("ordinal", "dtype")


def chunked(whole: DataFrame, values: str, size: int = CHUNK) -> DataFrame:
    """Split rows holding a whole tensor into chunk rows.

    A tensor without elements keeps one chunk without values, so no key is lost.
    """
    last = F.greatest(F.ceil(F.size(values) / size).cast("int"), F.lit(1)) - 1
    runs = F.transform(
        F.sequence(F.lit(0), last),
        lambda c: F.slice(F.col(values), c * size + 1, F.lit(size)),
    )
    facts = ["model_id", "tensor", *[c for c in STORED if c in whole.columns], "shape"]
    return (
        whole.filter(F.col(values).isNotNull())
        .select(*facts, F.posexplode(runs).alias("chunk", "part"))
        .select(
            *facts,
            "chunk",
            (F.col("chunk").cast("bigint") * size).alias("start"),
            F.col("part").cast("array<float>").alias("values"),
        )
    )


def elements(params: DataFrame, *keys: str) -> DataFrame:
    """One row per element; runs inside the stage at hand, nothing is shuffled.

    The outer form matters when ``values`` is computed, e.g. by a merge: the plain
    one is preceded by a size test that would compute the array a second time.
    """
    keep = keys or ("model_id", "tensor")
    return (
        params.select(*keep, "start", F.posexplode_outer("values").alias("pos", "value"))
        .filter(F.col("pos").isNotNull())
        .select(*keep, (F.col("start") + F.col("pos")).alias("idx"), "value")
    )


def layer_kind(name: Column) -> Column:
    """First matching rule wins, so a norm inside an attention block is attention."""
    lowered = F.lower(name)
    kind = None
    for label, words in K.LAYER_KINDS.items():
        test = lowered.rlike("|".join(words))
        kind = F.when(test, label) if kind is None else kind.when(test, label)
    return kind.otherwise("other")


def tensors(params: DataFrame) -> DataFrame:
    """One row per (model, tensor) from its first chunk: a column-pruned scan."""
    have = set(params.columns)
    kinds = {"ordinal": "bigint", "dtype": "string"}
    return params.filter(F.col("chunk") == 0).select(
        "model_id",
        "tensor",
        *[(F.col(c) if c in have else F.lit(None)).cast(kinds[c]).alias(c) for c in STORED],
        "shape",
        F.aggregate("shape", F.lit(1).cast("bigint"), lambda a, n: a * n).alias("numel"),
        layer_kind(F.col("tensor")).alias("kind"),
    )


def architecture(params: DataFrame) -> DataFrame:
    """Element counts at three depths: model, top-level name part, tensor.

    A tensor shows its shape, dtype and place in the model; a part the first place in it.
    """
    leaves = tensors(params).withColumn("prefix", F.substring_index("tensor", ".", 1))
    leaf = F.col("g") == 0
    return (
        leaves.rollup("model_id", "prefix", "tensor")
        .agg(
            F.sum("numel").alias("numel"),
            F.grouping_id().alias("g"),
            F.min("ordinal").alias("ordinal"),
            F.first("shape").alias("shape"),
            F.first("dtype").alias("dtype"),
        )
        .filter(F.col("model_id").isNotNull())
        .select(
            "model_id",
            F.when(leaf, 2).when(F.col("g") == 1, 1).otherwise(0).alias("depth"),
            F.when(leaf, F.col("prefix"))
            .when(F.col("g") == 1, F.col("model_id"))
            .otherwise(F.lit(""))
            .alias("parent"),
            F.coalesce("tensor", "prefix", "model_id").alias("name"),
            F.when(F.col("g") == 3, "root")
            .otherwise(layer_kind(F.coalesce("tensor", "prefix")))
            .alias("kind"),
            "numel",
            "ordinal",
            F.when(leaf, F.concat(F.lit("["), F.array_join("shape", ", "), F.lit("]"))).alias("shape"),
            F.when(leaf, F.col("dtype")).alias("dtype"),
        )
    )


def architecture_listing(params: DataFrame, max_depth: int = 3) -> DataFrame:
    """Depth-first display rows in stored order: a range sort, no row is gathered."""
    rows = architecture(params).filter(F.col("depth") <= max_depth)
    prefix = F.when(F.col("depth") == 2, F.col("parent")).when(F.col("depth") == 1, F.col("name"))
    return (
        rows.withColumn("prefix", F.coalesce(prefix, F.lit("")))
        .orderBy("model_id", "prefix", "depth", "ordinal", "name")
        .select(
            "model_id", "depth", "ordinal", "name", "kind", "shape", "dtype",
            (F.col("numel") / 1e6).alias("params_m"),
        )
    )


def layer_groups(params: DataFrame) -> DataFrame:
    """Tensor names by kind, one row each; scalars (empty shape) are left out."""
    return tensors(params).filter(F.size("shape") > 0).select("model_id", "kind", "tensor")


def to_bfloat16(params: DataFrame) -> DataFrame:
    """Round every element to bfloat16 precision, chunk by chunk."""
    return params.withColumn("values", N.per_chunk(N.round_bfloat16)("values"))


def aligned(params: DataFrame, base: str, models: list[str]) -> DataFrame:
    """Base chunks beside the matching chunks of each model as ``v0, v1, ...``.

    A model matches a tensor when it has one of equal shape; otherwise its column
    is null; models stored in different chunk sizes are refused. All joins share the key
    (tensor, chunk): each side is shuffled once, or not at all when the table was written
    by ``files.save_params_table``, bucketed on it. Several passes over one aligned
    frame reuse those exchanges as long as each pass asks for the same columns and
    adds no filter below them; the passes in this package take care to.
    """
    # Spelled out because a pass that joins per-tensor figures back implies it.
    keyed = params.filter(F.col("tensor").isNotNull() & F.col("chunk").isNotNull())
    out = keyed.filter(F.col("model_id") == base).select(
        "tensor", "chunk", "shape", "start", F.col("values").alias("base")
    )
    for i, model in enumerate(models):
        side = keyed.filter(F.col("model_id") == model).select(
            "tensor",
            "chunk",
            F.col("shape").alias("other"),
            F.col("start").alias("other_start"),
            F.col("values").alias(f"v{i}"),
        )
        # the same shape cut into other chunks must not be added element by element
        cut = (F.col("start") != F.col("other_start")) | (F.size("base") != F.size(f"v{i}"))
        fits = F.when(
            cut,
            F.raise_error(F.concat(F.lit(f"{model} is stored in other chunks than {base}: "), "tensor")),
        ).otherwise(F.col(f"v{i}"))
        out = (
            out.join(side, ["tensor", "chunk"], "left")
            .withColumn(f"v{i}", F.when(F.col("shape") == F.col("other"), fits))
            .drop("other", "other_start")
        )
    return out


def delta(params: DataFrame, base: str, model: str) -> DataFrame:
    """Chunked deltas of one model on the tensors it shares with the base."""
    return (
        aligned(params, base, [model])
        .filter(F.col("v0").isNotNull())
        .select(
            F.lit(model).alias("model_id"), "tensor", "shape", "chunk", "start",
            N.per_chunk(N.difference)("base", "v0").alias("values"),
        )
    )
