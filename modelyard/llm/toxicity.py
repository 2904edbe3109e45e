"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes ratios.

A feature is the presence of a hashed n-gram of lower-cased text. Its naive Bayes log-count
ratio compares how often it occurs in toxic and in other texts; the features with the
clearest ratios are kept, scaled by them, and weighed by a logistic regression.

The classifier is fitted on at most 2 * PER_CLASS labelled texts; scores cover whole texts.

Defined results: a null or empty text has no features and gets the score of none. Without
labelled rows of both kinds every score is the share of toxic labels (0 without labels).
Copies and repeated rows get equal scores; an empty table gives an empty table; extra
columns pass through and columns of the result's names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from modelyard.llm import features
from modelyard.llm.text import free_name
from modelyard.session import settled

SIZES = (3, 4, 5)
BITS = 18
PER_CLASS = 5000
FEATURES = 4096
ALPHA = 1.0
PENALTY = 1e-3
THRESHOLD = 0.7
ADDED = ("score", "predicted")


def presence(texts: list[str], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bins of every text in a row, and the texts' offsets.

    keep maps a bin to a feature number, or -1 for bins to leave out.
    """
    codes, offsets = features.code_points([t.lower() for t in texts])
    parts = [features.ngram_bins(codes, offsets, size, BITS) for size in SIZES]
    seen = np.zeros(1 << BITS if keep is None else int(keep.max(initial=-1)) + 1, bool)
    out, ends = [], [0]
    if keep is not None:
        kept = []
        for bins, at in parts:
            number = keep[bins]
            inside = number >= 0
            kept.append((number[inside], np.concatenate([[0], np.cumsum(inside)])[at]))
        parts = kept
    for i in range(len(texts)):
        for bins, at in parts:
            seen[bins[at[i] : at[i + 1]]] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        out.append(found)
        ends.append(ends[-1] + len(found))
    return (np.concatenate(out) if out else np.empty(0, np.int64)), np.array(ends)


@dataclass(frozen=True)
class Model:
    keep: np.ndarray  # feature number of each bin, or -1
    weight: np.ndarray  # per feature, the ratio included
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.weight):
            return np.full(len(texts), 1 / (1 + np.exp(-self.bias)))
        found, ends = presence(texts, self.keep)
        total = np.concatenate([[0.0], np.cumsum(self.weight[found])])
        return 1 / (1 + np.exp(-np.clip(total[ends[1:]] - total[ends[:-1]] + self.bias, -50, 50)))


def _bin_counts(batches):
    total = np.zeros((2, 1 << BITS), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in batches:
        label = batch.column("label").to_numpy()
        at = 0
        for part in features.chunks(batch.column("text")):
            found, ends = presence(part)
            for i in range(len(part)):
                y = label[at + i]
                total[y, found[ends[i] : ends[i + 1]]] += 1
                rows[y] += 1
            at += len(part)
    used = np.flatnonzero(total.sum(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1)), *[pa.array(np.append(total[y, used], rows[y])) for y in (0, 1)]],
        names=["bin", "n0", "n1"],
    )


def _found(keep: np.ndarray):
    def run(batches):
        for batch in batches:
            lists = []
            for part in features.chunks(batch.column("text")):
                found, ends = presence(part, keep)
                lists += [found[a:b].astype(np.int32) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("weight"), pa.array(lists, pa.list_(pa.int32()))],
                names=["label", "weight", "found"],
            )

    return run


def regress(
    found: np.ndarray, row: np.ndarray, y: np.ndarray, weight: np.ndarray, ratio: np.ndarray, rounds: int = 300
) -> tuple[np.ndarray, float]:
    """Penalised logistic regression on ratio-scaled presence, by Adam on the whole sample."""
    w, b = np.zeros(len(ratio)), float(np.log((weight[y == 1].sum() + 1) / (weight[y == 0].sum() + 1)))
    value = ratio[found]
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    total = weight.sum()
    for step in range(1, rounds + 1):
        z = np.bincount(row, w[found] * value, len(y)) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / total
        g = np.append(np.bincount(found, error[row] * value, len(w)) + PENALTY * w / 10, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w -= move[:-1]
        b -= move[-1]
    return w * ratio, float(b)


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "toxic") -> Model:
    sample = settled(features.labelled_sample(docs, labels, label, learnable, PER_CLASS))
    none = np.full(1 << BITS, -1, np.int32)
    rows = (
        sample.mapInArrow(_bin_counts, "bin bigint, n0 bigint, n1 bigint")
        .groupBy("bin")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .toPandas()
        .sort_values("bin")
    )
    weights = {r["label"]: r["w"] for r in sample.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    w0, w1 = weights.get(0, 0.0), weights.get(1, 0.0)
    if not w0 or not w1:
        share = w1 / (w0 + w1) if w0 + w1 else 0.0
        return Model(none, np.empty(0), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    size = rows[rows["bin"] < 0].iloc[0]
    rows = rows[rows["bin"] >= 0]
    p1 = (rows["n1"].to_numpy() + ALPHA) / (size["n1"] + 2 * ALPHA)
    p0 = (rows["n0"].to_numpy() + ALPHA) / (size["n0"] + 2 * ALPHA)
    ratio = np.log(p1 / p0)
    clear = np.abs(p1 - p0) / np.sqrt(p1 * (1 - p1) / size["n1"] + p0 * (1 - p0) / size["n0"])
    best = np.sort(np.argsort(-clear, kind="stable")[:FEATURES])
    keep = none
    keep[rows["bin"].to_numpy()[best]] = np.arange(len(best))
    ratio = ratio[best]
    data = sample.mapInArrow(_found(keep), "label int, weight double, found array<int>").toPandas()
    lists = [np.asarray(x, np.int64) for x in data["found"]]
    order = sorted(range(len(lists)), key=lambda i: (data["label"].iat[i], len(lists[i]), lists[i].tobytes()))
    lists = [lists[i] for i in order]
    data = data.iloc[order]
    weight, bias = regress(
        np.concatenate(lists),
        np.repeat(np.arange(len(lists)), [len(x) for x in lists]),
        data["label"].to_numpy(),
        data["weight"].to_numpy(),
        ratio,
    )
    return Model(keep, weight, bias)


def score(docs: DataFrame, scorer, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with score and predicted, from an object with score(texts); the text is left out."""
    taken = {*ADDED, text.lower()}
    rest = [c for c in docs.columns if c.lower() not in taken]
    body = free_name(docs, "text_to_read")
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(text).cast("string").alias(body))

    def run(batches):
        for batch in batches:
            parts = [scorer.score(part) for part in features.chunks(batch.column(batch.num_columns - 1))]
            s = np.concatenate(parts) if parts else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                names=[*batch.schema.names[:-1], *ADDED],
            )

    schema = StructType(
        [docs.schema[c] for c in rest]
        + [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    )
    return rows.mapInArrow(run, schema)
