"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed character n-grams, scaled to length one. Each
language has a few centroids (spherical k-means of its training texts); the language of
the centroid with the highest cosine wins. A text farther from it than nearly all training
texts of that language were is marked as rejected; its nearest language is still told.

Document frequencies come from all training rows; centroids from at most SAMPLE texts, an
equal number of each language, in the order of a hash of id and text.

Defined results: a null text or one without a letter is "und" with score 0, as is every
text if there is nothing to learn from. Very long texts are read whole. Ties go to the
language that is first in order. Copies and repeated rows get equal results; an empty
table gives an empty table. Extra columns pass through; columns of the result's names are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from modelyard.llm import features
from modelyard.llm.text import free_name

SIZES = (1, 2, 3)
BITS = 12
CENTROIDS = 3
SAMPLE = 6000  # training texts for centroids, over all languages
REJECT = 0.01  # share of a language's training texts that its distance limit leaves out
ADDED = ("lang_pred", "score", "rejected")


def counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed n-grams, a row per text."""
    codes, offsets = features.code_points([t.lower() for t in texts])
    width = 1 << BITS
    out = np.zeros(len(texts) * width, np.float32)
    for size in SIZES:
        bins, at = features.ngram_bins(codes, offsets, size, BITS)
        row = np.repeat(np.arange(len(texts)), np.diff(at))
        out += np.bincount(row * width + bins, minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), width)


def scaled(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length one; the logarithm keeps a foreign passage from outweighing a text."""
    x = np.log1p(x) * idf
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length == 0, 1, length)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # a row each
    owner: np.ndarray  # language number of each centroid
    limit: np.ndarray  # least cosine of each language

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        names, scores, far = [], [], []
        for begin in range(0, len(texts), 256):
            near = scaled(counts(texts[begin : begin + 256]), self.idf) @ self.centroids.T
            best = near.argmax(axis=1)
            cosine = near[np.arange(len(near)), best]
            own = self.owner[best]
            names += [self.languages[k] for k in own]
            scores.append(np.clip(cosine, 0, 1))
            far.append(cosine < self.limit[own])
        return names, np.concatenate(scores).astype(float), np.concatenate(far)


def _frequencies(batches):
    total, rows = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for part in features.chunks(batch.column("text")):
            for begin in range(0, len(part), 256):
                total += (counts(part[begin : begin + 256]) > 0).sum(axis=0)
            rows += len(part)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1)), pa.array(np.append(total[used], rows))], names=["bin", "n"]
    )


def _vectors(batches):
    for batch in batches:
        for texts in features.portions(batch, "text", features.CHUNK):
            for begin in range(0, texts.num_rows, 256):
                part = texts.slice(begin, 256)
                x = counts([t.as_py() or "" for t in part.column("text")])
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"]
                )


def _k_means(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means; starts are the means of layers by closeness to the common mean.

    Starting from outliers instead would give texts with a foreign passage a centroid.
    """
    layers = np.array_split(x[np.argsort(x @ x.mean(axis=0), kind="stable")], min(k, len(x)))
    c = np.array([layer.mean(axis=0) for layer in layers])
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.array([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _sample(rows: DataFrame, per_language: int) -> DataFrame:
    """(lang, text) of per_language rows of every language, or all it has, in the order of h.

    Counts per hash range tell how far the order is read, so a window holds little more
    than the ranges and the wanted rows. Rows that tie are alike and taken by their number.
    """
    upto = Window.partitionBy("lang").orderBy(F.col("part")).rowsBetween(Window.unboundedPreceding, -1)
    part = F.shiftright("h", 52)
    ends = (
        rows.groupBy("lang", part.alias("part"))
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
        .filter(F.col("before") < per_language)
        .groupBy("lang")
        .agg(F.max("part").alias("last"))
    )
    ordered = Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    taken = (
        rows.select("lang", "h")
        .join(F.broadcast(ends), "lang")
        .filter(part <= F.col("last"))
        .groupBy("lang", "h")
        .agg(F.count("*").alias("n"))
        .withColumn("free", per_language - F.coalesce(F.sum("n").over(ordered), F.lit(0)))
        .filter("free > 0")
        .select("lang", "h", F.least("n", "free").cast("int").alias("times"))
    )
    return (
        rows.join(F.broadcast(taken), ["lang", "h"])
        .dropDuplicates(["lang", "h"])
        .select("lang", F.explode(F.array_repeat("text", F.col("times"))).alias("text"))
    )


def fit(docs: DataFrame, learnable: Column, text: str = "text", lang: str = "lang") -> Model | None:
    """Learn from rows that learnable marks and whose language is not null.

    A doc_id has a part in the order of the sample only: with the text it gives the hash by
    which rows are taken. The model has CENTROIDS rows of 2^BITS floats for each language.
    """
    key = [F.col("doc_id")] if "doc_id" in docs.columns else []
    rows = docs.filter(learnable & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"),
        F.col(lang).cast("string").alias("lang"),
        F.xxhash64(F.lit(3), *key, text).alias("h"),
    )
    n_languages = rows.select("lang").distinct().count()
    if not n_languages:
        return None
    found = rows.mapInArrow(_frequencies, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n"))
    df = {r["bin"]: r["n"] for r in found.collect()}
    idf = np.zeros(1 << BITS, np.float32)
    total = df.pop(-1)
    for k, n in df.items():
        idf[k] = np.log((1 + total) / (1 + n)) + 1
    sample = _sample(rows, max(1, SAMPLE // n_languages)).mapInArrow(_vectors, "lang string, x binary").toPandas()
    languages = sorted(sample["lang"].unique())
    centroids, owner, limit = [], [], []
    for number, name in enumerate(languages):
        raw = np.sort(sample.loc[sample["lang"] == name, "x"].to_numpy())
        x = scaled(np.array([np.frombuffer(v, np.float32) for v in raw]), idf)
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            limit.append(1.0)
            continue
        c = _k_means(x, CENTROIDS)
        centroids.append(c)
        owner += [number] * len(c)
        limit.append(float(np.quantile((x @ c.T).max(axis=1), REJECT)))
    if not centroids:
        return None
    return Model(languages, idf, np.concatenate(centroids).astype(np.float32), np.array(owner), np.array(limit))


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with lang_pred, score (cosine, 0 to 1) and rejected; the text is left out."""
    taken = {*ADDED, text.lower()}
    rest = [c for c in docs.columns if c.lower() not in taken]
    letter = free_name(docs, "has_letter")
    body = free_name(docs, "text_to_read")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in rest],
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias(letter),
        F.col(text).cast("string").alias(body),
    )
    if model is None:
        return rows.drop(body, letter).withColumns(
            {"lang_pred": F.lit("und"), "score": F.lit(0.0), "rejected": F.lit(True)}
        )

    def run(batches):
        for batch in batches:
            names, scores, far = [], [], []
            for part in features.chunks(batch.column(batch.num_columns - 1)):
                a, b, c = model.predict(part)
                names += a
                scores.append(b)
                far.append(c)
            lettered = batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False)
            score = np.where(lettered, np.concatenate(scores), 0.0) if scores else np.empty(0)
            rejected = np.concatenate(far) | ~lettered if far else np.empty(0, bool)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-2],
                    pa.array([n if ok else "und" for n, ok in zip(names, lettered)], pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=[*batch.schema.names[:-2], *ADDED],
            )

    schema = StructType(
        [docs.schema[c] for c in rest]
        + [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
    )
    return rows.mapInArrow(run, schema)
