"""Quality scores from random-indexing word vectors and a small network.

Every token bin has a fixed sparse index vector of signs. A bin's word vector is the sum of
the index vectors of its neighbours (up to REACH places away) over all texts. A document
is pooled to the mean and the spread of its tokens' vectors, with its length and its share
of distinct tokens; a two-layer network, with a temperature fitted on rows it has not seen, turns that into the probability of good.

Word vectors come from all texts; the network is fitted on at most 2 * PER_CLASS labelled
texts.

Defined results: a null or empty text pools to zeros and gets the network's score of that.
Without labels of both kinds every score is the share of good labels (1 without labels).
Copies and repeated rows get equal scores; an empty table gives an empty table; extra
columns pass through and columns of the result's names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.llm import features
from modelyard.llm.toxicity import score as score_texts
from modelyard.session import settled

BITS = 14
DIM = 32
SIGNS = 2  # entries of an index vector that are not zero
REACH = 2
PER_CLASS = 5000
HIDDEN = 32
ROUNDS = 400
THRESHOLD = 0.3


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every bin's index vector."""
    random = np.random.Generator(np.random.PCG64(7))
    return random.integers(0, DIM, (1 << BITS, SIGNS)), random.choice([-1.0, 1.0], (1 << BITS, SIGNS))


def neighbour_sums(batches):
    """Per task: the sum of the neighbours' index vectors of every bin."""
    place, sign = index_vectors()
    total = np.zeros((1 << BITS) * DIM)
    for batch in batches:
        for part in features.chunks(batch.column("text")):
            bins, at = features.token_bins(*features.code_points(part), BITS)
            row = np.repeat(np.arange(len(part)), np.diff(at))
            for apart in range(1, REACH + 1):
                same = row[apart:] == row[:-apart]
                left, right = bins[:-apart][same], bins[apart:][same]
                for own, other in ((left, right), (right, left)):
                    for k in range(SIGNS):
                        total += np.bincount(own * DIM + place[other, k], sign[other, k], len(total))
    table = total.reshape(-1, DIM)
    used = np.flatnonzero(table.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), *[pa.array(table[used, d]) for d in range(DIM)]],
        names=["bin", *[f"d{d}" for d in range(DIM)]],
    )


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Vectors of length one for all bins; DIM * 2^BITS numbers whatever the corpus."""
    names = [f"d{d}" for d in range(DIM)]
    sums = (
        docs.select(F.col(text).cast("string").alias("text"))
        .mapInArrow(neighbour_sums, "bin bigint, " + ", ".join(f"{n} double" for n in names))
        .groupBy("bin")
        .agg(*[F.sum(n).alias(n) for n in names])
        .toPandas()
    )
    out = np.zeros((1 << BITS, DIM), np.float32)
    out[sums["bin"].to_numpy(int)] = sums[names].to_numpy()
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length == 0, 1, length)


def pooled(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of every text, its length and its share of
    distinct tokens."""
    bins, at = features.token_bins(*features.code_points(texts), BITS)
    out = np.zeros((len(texts), 2 * DIM + 2))
    for i in range(len(texts)):
        own = bins[at[i] : at[i + 1]]
        if len(own):
            x = vectors[own]
            mean = x.mean(axis=0)
            out[i, :DIM] = mean
            out[i, 2 * DIM] = np.log1p(len(own))
            out[i, 2 * DIM + 1] = len(np.unique(own)) / len(own)
            out[i, DIM : 2 * DIM] = np.sqrt(np.maximum(np.einsum("ij,ij->j", x, x) / len(x) - mean * mean, 0))
    return out


@dataclass(frozen=True)
class Network:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple  # weights and biases of both layers, or ()
    temperature: float
    share: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, texts: list[str]) -> np.ndarray:
        if not self.layers:
            return np.full(len(texts), self.share)
        z = self.logits(pooled(texts, self.vectors)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, vectors: np.ndarray) -> Network:
    """Fit the layers on four fifths of the rows and the temperature on the rest."""
    random = np.random.Generator(np.random.PCG64(11))
    part = random.permutation(len(x))
    rest, own = part[: len(x) // 5], part[len(x) // 5 :]
    centre, scale = x[own].mean(axis=0), x[own].std(axis=0) + 1e-6
    z = (x - centre) / scale
    size = x.shape[1]
    p = [
        random.normal(0, 1 / np.sqrt(size), (size, HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, ROUNDS + 1):
        h = np.tanh(z[own] @ p[0] + p[1])
        out = 1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -50, 50)))
        error = weight[own] * (out - y[own]) / weight[own].sum()
        back = np.outer(error, p[2]) * (1 - h * h)
        grads = [z[own].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ error + 1e-4 * p[2], error.sum(keepdims=True)]
        for k, g in enumerate(grads):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            p[k] -= 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-9)
    net = Network(vectors, centre, scale, (p[0], p[1], p[2], float(p[3][0])), 1.0, 0.0)
    if not len(rest):
        return net
    raw = net.logits(x[rest])

    def loss(t: float) -> float:
        s = np.clip(1 / (1 + np.exp(-np.clip(raw / t, -50, 50))), 1e-9, 1 - 1e-9)
        return -float((weight[rest] * (y[rest] * np.log(s) + (1 - y[rest]) * np.log(1 - s))).sum())

    best = min(np.geomspace(0.25, 8, 60), key=loss)
    return Network(vectors, centre, scale, net.layers, float(best), 0.0)


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "quality") -> Network:
    vectors = word_vectors(docs)
    sample = settled(features.labelled_sample(docs, labels, label, learnable, PER_CLASS))

    def run(batches):
        for batch in batches:
            rows = [pooled(part, vectors) for part in features.chunks(batch.column("text"))]
            if rows:
                lists = pa.array(list(np.concatenate(rows)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label"), batch.column("weight"), lists], names=["label", "weight", "x"]
                )

    data = sample.mapInArrow(run, "label int, weight double, x array<double>").toPandas()
    good = data.loc[data["label"] == 1, "weight"].sum()
    bad = data.loc[data["label"] == 0, "weight"].sum()
    if not good or not bad:
        share = 1.0 if not bad else 0.0
        return Network(vectors, np.empty(0), np.empty(0), (), 1.0, share)
    x = np.array(data["x"].tolist())
    order = np.lexsort(np.column_stack([x, data["label"].to_numpy()]).T)
    return train(x[order], data["label"].to_numpy()[order], data["weight"].to_numpy()[order], vectors)


def score(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """docs with score (probability of good) and predicted; the text is left out."""
    return score_texts(docs, network, text, THRESHOLD)
