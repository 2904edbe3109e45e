"""Merging model weights, chunk against chunk.

Every strategy returns chunk rows of the base layout, so results can be written,
merged again or exploded. Joins bring the chunks of the models together, plain
aggregations give the figures per tensor, and a small array kernel does the element
arithmetic of one chunk.

Per-tensor figures (weights, thresholds) are small, but they are not broadcast: they
are spread over the chunk numbers of their tensor and joined on (tensor, chunk), the
key the weights are already partitioned by. That moves no weights and leaves no
tensor, however large, in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.functions import kernels as N
from modelyard.operators.parameters import aligned
from modelyard.session import written


def _models(n: int, prefix: str = "v") -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def _result(wide: DataFrame, model_id: str, values: Column) -> DataFrame:
    return wide.select(
        F.lit(model_id).alias("model_id"), "tensor", "shape", "chunk", "start", values.alias("values")
    )


def _per_chunk(per_tensor: DataFrame) -> DataFrame:
    """Repeat per-tensor rows for each chunk number 0..last of the tensor."""
    return per_tensor.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("last")))
    ).drop("last")


def _last_chunk() -> Column:
    """Highest chunk number. Asking for ``start`` keeps the exchange reusable."""
    return F.max(F.when(F.col("start") >= 0, F.col("chunk")))


# --- spherical interpolation -------------------------------------------------


def _slerp_figures(pairs: DataFrame) -> DataFrame:
    """Squared norms and dot product: summed per chunk in the kernel, then per tensor."""
    sums = pairs.select(
        "tensor", "chunk", "start", N.per_chunk_sums(N.dot_products)("base", "v0").alias("s")
    )
    return sums.groupBy("tensor").agg(
        *[F.sum(F.get("s", F.lit(i))).alias(name) for i, name in enumerate(("xx", "yy", "xy"))],
        _last_chunk().alias("last"),
    )


def slerp_weights(pairs: DataFrame, alpha: float) -> DataFrame:
    """Two weights per tensor; straight-line weights for tiny norms or angles."""
    n0, n1 = F.sqrt("xx"), F.sqrt("yy")
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("xy") / (n0 * n1)))
    figures = _slerp_figures(pairs).withColumn(
        "theta", F.when((n0 >= 1e-8) & (n1 >= 1e-8), F.acos(cosine))
    )
    theta = F.col("theta")
    straight = theta.isNull() | (F.abs(theta) < 1e-6)

    # An angle of pi has no guard in the specification; a plain division by the
    # (tiny, non-zero) sine is kept.
    def weight(share: float) -> Column:
        bent = F.try_divide(F.sin(share * theta), F.sin(theta))
        return F.when(straight, F.lit(share)).otherwise(bent)

    return figures.select(
        "tensor", "last", weight(1.0 - alpha).alias("w0"), weight(alpha).alias("w1")
    )


def slerp(
    params: DataFrame, model_a: str, model_b: str, alpha: float = K.SCALING, name: str = "merged"
) -> DataFrame:
    """Interpolate tensors both models share; other tensors of A stay as they are."""
    pairs = aligned(params, model_a, [model_b])
    weights = _per_chunk(slerp_weights(pairs, alpha))
    wide = pairs.join(weights, ["tensor", "chunk"], "left")
    return _result(wide, name, N.per_chunk(N.mix)("base", "v0", "w0", "w1"))


# --- sums of deltas ----------------------------------------------------------


def task_arithmetic(
    params: DataFrame,
    base: str,
    models: list[str],
    scaling: float = K.SCALING,
    weights: list[float] | None = None,
    name: str = "merged",
) -> DataFrame:
    """Base plus scaled sum of deltas; ``weights`` turns the sum into a weighted one."""
    wide = aligned(params, base, models)
    move = N.per_chunk(N.weighted_move(scaling, weights or [1.0] * len(models)))
    return _result(wide, name, move("base", *_models(len(models))))


def equal_weights(models: list[str]) -> list[float]:
    return [1.0 / len(models)] * len(models)


# --- trimming by magnitude ---------------------------------------------------


POINTS = 256  # of a summary
FAN = 64  # summaries merged into one


def joined_once(params: DataFrame, base: str, models: list[str], points: int = POINTS) -> DataFrame:
    """Aligned chunks, written, with a summary of every model's magnitudes as ``q0, q1, ...``.

    The models are joined here and nowhere later: brackets read the summaries alone, the
    selection and the merge read the values, each by a plain scan.
    """
    summary = N.per_chunk_counts(N.magnitude_summary(points), "bits")
    wide = aligned(params, base, models)
    return written(
        wide.select("*", *[summary("base", v).alias(f"q{i}") for i, v in enumerate(_models(len(models)))]),
        "joined-models",
    )


def _by_model(rows: DataFrame, n_models: int, pairs: str) -> DataFrame:
    """Rows (tensor, chunk, model, step, bits, n) of the pairs of arrays ``pairs0, pairs1, ...``.

    step is the largest n of a chunk, on its first row and 0 on the others.
    """
    each = F.array(*[F.struct(F.lit(i).alias("model"), F.col(f"{pairs}{i}").alias("p")) for i in range(n_models)])
    return (
        rows.select("tensor", "chunk", F.inline_outer(each))
        .select("tensor", "chunk", "model", F.array_max("p.n").alias("most"), F.posexplode_outer(F.arrays_zip("p.bits", "p.n")))
        .filter(F.col("pos").isNotNull())
        .select("tensor", "chunk", "model", F.when(F.col("pos") == 0, F.col("most")).otherwise(0).alias("step"), "col.bits", "col.n")
    )


def _merged_summaries(points: DataFrame, fan: int, size: int) -> DataFrame:
    """One summary for every ``fan`` neighbouring ones, again of about ``size`` points.

    A point stands for those dropped before it. slack, how much sums of n may undercount,
    grows by less than the largest n that results.
    """
    key = ["tensor", "model", "chunk"]
    whole, falling = W.partitionBy(*key), W.partitionBy(*key).orderBy(F.desc("bits"), "n")
    step = F.ceil(F.col("total") / size)
    kept = (
        points.withColumn("chunk", F.floor(F.col("chunk") / fan).cast("int"))
        .withColumn("total", F.sum("n").over(whole))
        .withColumn("slack", F.sum("slack").over(whole))
        .withColumn("cum", F.sum("n").over(falling.rowsBetween(W.unboundedPreceding, 0)))
        .filter((F.floor(F.col("cum") / step) > F.floor((F.col("cum") - F.col("n")) / step)) | (F.col("cum") == F.col("total")))
        .withColumn("n", F.col("cum") - F.coalesce(F.lag("cum").over(falling), F.lit(0)))
        .withColumn("first", F.row_number().over(falling) == 1)
        .withColumn("most", F.max("n").over(whole))
    )
    slack = F.when(F.col("first"), F.col("slack") + F.col("most") - 1).otherwise(0)
    return kept.select(*key, "bits", "n", slack.alias("slack"))


def brackets(joined: DataFrame, n_models: int, density: float, fan: int = FAN, size: int = POINTS) -> DataFrame:
    """(tensor, model, k, low, high): low <= k-th largest magnitude < high, as float bits.

    Summaries are merged as a tree, so a window sees at most fan * size points.
    """
    points = _by_model(joined, n_models, "q").select(
        "tensor", "model", "chunk", "bits", "n", F.greatest(F.col("step") - 1, F.lit(0)).alias("slack")
    )
    last = joined.agg(F.max("chunk")).first()[0] or 0
    while last >= fan:
        points, last = _merged_summaries(points, fan, size), last // fan
    whole = W.partitionBy("tensor", "model")
    atleast = F.sum("n").over(whole.orderBy(F.desc("bits")).rangeBetween(W.unboundedPreceding, 0))
    k = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("total") * F.lit(density)).cast("bigint"))
    return (
        points.withColumn("total", F.sum("n").over(whole))
        .withColumn("slack", F.sum("slack").over(whole))
        .withColumn("cum", atleast)
        .withColumn("k", k)
        .groupBy("tensor", "model", "k")
        .agg(
            F.max(F.when(F.col("cum") >= F.col("k"), F.col("bits"))).alias("low"),
            F.coalesce(F.min(F.when(F.col("cum") + F.col("slack") < F.col("k"), F.col("bits"))), F.lit(2**31 - 1)).alias("high"),
        )
    )


def trim_thresholds(joined: DataFrame, n_models: int, density: float = K.DENSITY) -> DataFrame:
    """Exact k-th largest |delta| per (tensor, model), k = max(1, int(n * density)).

    Brackets come from the summaries. One scan of the values then counts what lies inside, a
    few in a hundred; what lies outside is counted at the nearer end. Among the candidates a
    radix selection finds rank k: their upper 16 bits first, then the lower ones.
    """
    key = ["tensor", "model"]
    bounds = written(brackets(joined, n_models, density), "brackets")
    cut = _spread(joined, _across_models(bounds, n_models, "low", "high"))
    count = N.per_chunk_counts(N.magnitudes_between, "bits")
    inside = cut.select(
        "tensor",
        "chunk",
        *[count("base", f"v{i}", F.col("lows")[i], F.col("highs")[i]).alias(f"c{i}") for i in range(n_models)],
    )
    candidates = written(
        _by_model(inside, n_models, "c").filter("n > 0").groupBy(*key, "bits").agg(F.sum("n").alias("n")), "candidates"
    )

    def chosen(rows: DataFrame, by: str, rank: str, *names: str) -> DataFrame:
        """The value of ``by`` that holds the rank, and the rank that is left inside it."""
        falling = W.partitionBy(*key).orderBy(F.desc(by)).rowsBetween(W.unboundedPreceding, 0)
        above = F.col("cum") - F.col("n")
        return (
            rows.withColumn("cum", F.sum("n").over(falling))
            .filter((F.col("cum") >= F.col(rank)) & (above < F.col(rank)))
            .select(*key, *names, by, (F.col(rank) - above).alias("rest"))
        )

    halves = candidates.withColumn("upper", F.shiftright("bits", 16)).join(bounds.select(*key, "k"), key)
    upper = chosen(halves.groupBy(*key, "k", "upper").agg(F.sum("n").alias("n")), "upper", "k")
    lower = chosen(halves.drop("k").join(upper, [*key, "upper"]).select(*key, "bits", "n", "rest"), "bits", "rest")
    return lower.select(*key, N.value_of_bits("bits").alias("threshold"))


def _across_models(rows: DataFrame, n_models: int, *names: str) -> DataFrame:
    """One row per tensor with arrays by model number: ``low`` -> ``lows``."""
    return rows.groupBy("tensor").agg(
        *[F.array(*[F.max(F.when(F.col("model") == i, F.col(c))) for i in range(n_models)]).alias(f"{c}s") for c in names]
    )


def _spread(joined: DataFrame, per_tensor: DataFrame) -> DataFrame:
    """joined with per-tensor figures, repeated per chunk so that the key is even."""
    last = joined.groupBy("tensor").agg(F.max("chunk").alias("last"))
    return joined.join(_per_chunk(per_tensor.join(last, "tensor")), ["tensor", "chunk"], "left")


def with_thresholds(params: DataFrame, base: str, models: list[str], density: float) -> DataFrame:
    """Aligned chunks with the threshold of every model as ``t0, t1, ...``."""
    n = len(models)
    joined = joined_once(params, base, models)
    cut = _spread(joined, _across_models(trim_thresholds(joined, n, density), n, "threshold"))
    return cut.select(
        "tensor", "chunk", "shape", "start", "base", *_models(n),
        *[F.col("thresholds")[i].alias(f"t{i}") for i in range(n)],
    )


def trimmed(params: DataFrame, base: str, models: list[str], density: float = K.DENSITY) -> DataFrame:
    """Aligned chunks with trimmed deltas ``d0, d1, ...``: below the limit is zero."""
    n = len(models)
    wide = with_thresholds(params, base, models, density)
    cut = N.per_chunk(N.cut_below)
    return wide.select(
        "tensor", "chunk", "shape", "start", "base",
        *[cut("base", f"v{i}", f"t{i}").alias(f"d{i}") for i in range(n)],
    )


def trimmed_rows(params: DataFrame, base: str, models: list[str], density: float) -> DataFrame:
    """Trimmed deltas as chunk rows per model."""
    parts = F.array(
        *[
            F.struct(F.lit(m).alias("model_id"), F.col(f"d{i}").alias("values"))
            for i, m in enumerate(models)
        ]
    )
    return (
        trimmed(params, base, models, density)
        .select("tensor", "shape", "chunk", "start", F.inline_outer(parts))
        .filter(F.col("values").isNotNull())
        .select("model_id", "tensor", "shape", "chunk", "start", "values")
    )


def elected(params: DataFrame, base: str, models: list[str], density: float = K.DENSITY) -> DataFrame:
    """Elected sign per element of the trimmed deltas, as chunk rows."""
    cut = trimmed(params, base, models, density)
    return cut.select(
        "tensor", "chunk", "start",
        N.per_chunk(N.elected_signs)("base", *_models(len(models), "d")).alias("values"),
    )


def ties(
    params: DataFrame,
    base: str,
    models: list[str],
    density: float = K.DENSITY,
    scaling: float = K.SCALING,
    weights: list[float] | None = None,
    name: str = "merged",
) -> DataFrame:
    """Trim, elect a sign per element, merge what agrees. Unmatched tensors keep base."""
    n = len(models)
    wide = with_thresholds(params, base, models, density)
    vote = N.per_chunk(N.trimmed_vote(scaling, weights or [1.0] * n))
    return _result(wide, name, vote("base", *_models(n), *_models(n, "t")))


# --- random drop -------------------------------------------------------------


def draw_head(seed: int, model: str) -> Column:
    """A 32-bit number per (seed, model, tensor) from which the draws derive."""
    text = F.concat(F.lit(f"{seed}:{model}:"), F.col("tensor"))
    return F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("bigint")


def dare_ties(
    params: DataFrame,
    base: str,
    models: list[str],
    density: float = K.DENSITY,
    scaling: float = K.SCALING,
    seed: int = 0,
    weights: list[float] | None = None,
    name: str = "merged",
) -> DataFrame:
    """Random drop and rescale, then the sign election of the trimmed merge."""
    n = len(models)
    wide = aligned(params, base, models)
    vote = N.per_chunk(N.thinned_vote(scaling, weights or [1.0] * n, density))
    heads = [draw_head(seed, m) for m in models]
    return _result(wide, name, vote("start", "base", *_models(n), *heads))


# --- consensus ---------------------------------------------------------------


def breadcrumbs(
    params: DataFrame,
    base: str,
    models: list[str],
    density: float = K.DENSITY,
    epsilon: float = K.EPSILON,
    name: str = "merged",
) -> DataFrame:
    """Mean delta where all signs agree (zero is a sign) and the mean is not tiny.

    ``density`` is accepted and has no effect, as specified.
    """
    wide = aligned(params, base, models)
    return _result(wide, name, N.per_chunk(N.consensus(epsilon))("base", *_models(len(models))))


# --- low-rank adapters -------------------------------------------------------

BLOCK_ELEMENTS = 1 << 24  # of a weight block: 64 MB


def _block_rows(values: str) -> Column:
    """Rows of a block of that column width."""
    return F.greatest(F.lit(1), F.expr(f"{BLOCK_ELEMENTS} div greatest(size({values}), 1)")).cast("bigint")


def merge_low_rank(
    weight: DataFrame,
    side_a: DataFrame,
    side_b: DataFrame,
    rank: int,
    alpha: float,
) -> DataFrame:
    """W + (alpha / rank) * B A for matrices chunked by row.

    ``weight(tensor, row, chunk, start, values)`` holds part of one row;
    ``side_a(tensor, r, chunk, values)`` holds rank rows cut at the same columns;
    ``side_b(tensor, row, factors)`` holds the ``rank`` factors of one row.

    All three are dealt over one grid of blocks: a column chunk by as many rows as make
    BLOCK_ELEMENTS. A column chunk of A goes to the blocks below each other, that is once per
    64 MB of weights; the factors of a row go to the blocks beside each other. Weights are
    shuffled once, sorted by block, and pass as a stream: a task holds one column chunk of A
    and a few rows. No (row, rank, column) triples are emitted.
    """
    block = ["tensor", "chunk", "grp"]
    widths = side_a.groupBy("tensor", "chunk").agg(F.max(_block_rows("values")).alias("high"))
    tops = side_b.groupBy("tensor").agg(F.max("row").alias("top"))
    runs = side_a.withColumn("high", _block_rows("values")).join(tops, "tensor").select(
        "tensor",
        "chunk",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("top div high"))).alias("grp"),
        F.lit(0).alias("kind"),
        F.col("r").cast("bigint").alias("row"),
        F.col("values").cast("array<double>").alias("factors"),
    )
    factors = side_b.join(widths, "tensor").select(
        "tensor", "chunk", F.expr("row div high").alias("grp"), F.lit(1).alias("kind"), "row",
        F.col("factors").cast("array<double>").alias("factors"),
    )
    parts = weight.withColumn("high", _block_rows("values")).select(
        "tensor", "chunk", F.expr("row div high").alias("grp"), F.lit(2).alias("kind"), "row", "start", "values"
    )
    dealt = (
        parts.unionByName(runs, allowMissingColumns=True)
        .unionByName(factors, allowMissingColumns=True)
        .repartition(*block)
        .sortWithinPartitions(*block, F.col("kind") > 0, "row", "kind")
    )
    schema = weight.select("tensor", "row", "chunk", "start", F.col("values").cast("array<float>").alias("values")).schema
    return dealt.mapInArrow(N.fold_blocks(alpha / rank, rank), schema)


# --- dispatch ----------------------------------------------------------------


def merge_models(
    params: DataFrame,
    strategy: str,
    models: list[str],
    base_model: str | None = None,
    density: float = K.DENSITY,
    alpha: float = K.SCALING,
    name: str = "merged",
    weights: list[float] | None = None,
) -> DataFrame:
    """Strategy by name; base defaults to the first model.

    ``weights`` are those of the merged models in order, where the strategy sums deltas.

    The other models are all listed ones except the base, so an explicit base
    outside the list does not silently drop the first model.
    """
    if strategy not in K.MERGE_STRATEGIES:
        raise ValueError(f"Unknown strategy: {strategy}")
    if strategy == "slerp":
        return slerp(params, models[0], models[1], alpha, name)
    base = base_model or models[0]
    others = [m for m in models if m != base]
    if strategy == "task_arithmetic":
        return task_arithmetic(params, base, others, alpha, weights=weights, name=name)
    if strategy == "ties":
        return ties(params, base, others, density, alpha, weights=weights, name=name)
    if strategy == "dare_ties":
        return dare_ties(params, base, others, density, alpha, weights=weights, name=name)
    return breadcrumbs(params, base, others, density, name=name)
