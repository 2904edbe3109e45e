"""The toxicity and quality models, from text to score, against plain loops over small tables."""

import math
import random
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.llm import quality_classifier as Q
from modelyard.llm import toxicity as X

MASK = 2**64 - 1
ODD, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def small_corpus():
    r = random.Random(9)
    kind = ["lovely", "garden", "reading", "bright", "music", "über", "день"]
    nasty = ["stupid", "awful", "trash", "hate", "reading", "bright", "день"]
    rows = []
    for i in range(90):
        bad = i % 3 == 0
        text = " ".join(r.choice(nasty if bad else kind) for _ in range(r.randint(1, 25)))
        rows.append((i, text if i % 29 else text + "  !!\n" + text.upper(), int(bad)))
    return [*rows, (200, "", 0), (201, None, 1), (202, "x", 0), (203, "\U0001f642 ok-ok", 0)]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = small_corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, label int").repartition(2)
    return rows, docs, labels


def mixed(h, bits):
    return ((h ^ (h >> 32)) * ODD & MASK) >> (64 - bits)


def ngram_set(text):
    text, found = (text or "").lower(), set()
    for size in X.SIZES:
        for i in range(len(text) - size + 1):
            h = size
            for c in text[i : i + size]:
                h = (h + ord(c)) * STEP & MASK
            found.add(mixed(h, X.BITS))
    return found


def test_toxicity_from_text_to_score(spark, corpus):
    rows, docs, labels = corpus
    sets = [ngram_set(t) for _, t, _ in rows]
    y = np.array([label for _, _, label in rows], float)
    n = {k: sum(y == k) for k in (0, 1)}
    ratio, clear = {}, {}
    for b in sorted(set().union(*sets)):
        p = {k: (sum(b in s for s, v in zip(sets, y) if v == k) + 1) / (n[k] + 2) for k in (0, 1)}
        ratio[b] = math.log(p[1] / p[0])
        clear[b] = abs(p[1] - p[0]) / math.sqrt(sum(p[k] * (1 - p[k]) / n[k] for k in (0, 1)))
    best = sorted(sorted(ratio, key=lambda b: -clear[b])[: X.FEATURES])
    value = np.array([[ratio[b] if b in s else 0.0 for b in best] for s in sets])
    w, bias = np.zeros(len(best)), math.log((n[1] + 1) / (n[0] + 1))
    m, v = np.zeros(len(best) + 1), np.zeros(len(best) + 1)
    for step in range(1, 301):
        error = (1 / (1 + np.exp(-(value @ w + bias))) - y) / len(y)
        g = np.append(value.T @ error + X.PENALTY / 10 * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        move = 0.05 * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    wanted = 1 / (1 + np.exp(-(value @ w + bias)))
    model = X.fit(docs, labels.withColumnRenamed("label", "toxic"), F.lit(True))
    got = {x.doc_id: x for x in X.score(docs, model).collect()}
    for (i, _, _), p in zip(rows, wanted):
        assert abs(got[i].score - p) < 1e-6 and got[i].predicted == int(got[i].score >= 0.7)
    assert sum(got[i].predicted == label for i, _, label in rows) >= len(rows) - 6


def token_list(text):
    def kind(c):
        if ord(c) >= 0x3000:
            return 1
        return 1 if c.isalnum() else 0 if c.isspace() else 2

    out = []
    for k, run in groupby(text or "", kind):
        if k:
            total = 0
            for place, c in enumerate(run):
                x = (ord(c) + 1) * ODD & MASK
                total += (x ^ (x >> 29)) * ((2 * place + 1) * STEP & MASK)
            out.append(mixed(total & MASK, Q.BITS))
    return out


def test_quality_from_text_to_score(spark, corpus):
    rows, docs, labels = corpus
    place, sign = Q.index_vectors()
    lists = [token_list(t) for _, t, _ in rows]
    vectors = {}
    for tokens in lists:
        for i, own in enumerate(tokens):
            for j in range(max(0, i - Q.REACH), min(len(tokens), i + Q.REACH + 1)):
                if i != j:
                    for at, s in zip(place[tokens[j]], sign[tokens[j]]):
                        vectors.setdefault(own, np.zeros(Q.DIM))[at] += s
    unit = {}
    for b, x in vectors.items():
        x = x.astype(np.float32)
        unit[b] = x / (np.linalg.norm(x) or 1)
    features = np.zeros((len(rows), 2 * Q.DIM + 2))
    for k, tokens in enumerate(lists):
        if tokens:
            x = np.array([unit.get(b, np.zeros(Q.DIM)) for b in tokens])
            spread = np.sqrt(np.maximum((x**2).mean(axis=0) - x.mean(axis=0) ** 2, 0))
            features[k] = [*x.mean(axis=0), *spread, math.log1p(len(tokens)), len(set(tokens)) / len(tokens)]
    network = Q.fit(docs, labels.withColumnRenamed("label", "quality"), F.lit(True))
    np.testing.assert_allclose(Q.pooled([t or "" for _, t, _ in rows], network.vectors), features, atol=2e-4)
    w1, b1, w2, b2 = network.layers
    got = {x.doc_id: x for x in Q.score(docs, network).collect()}
    for (i, _, _), x in zip(rows, features):
        hidden = [math.tanh(sum(a * c for a, c in zip((x - network.centre) / network.scale, w1[:, h])) + b1[h]) for h in range(Q.HIDDEN)]
        z = (sum(a * c for a, c in zip(hidden, w2)) + b2) / network.temperature
        assert abs(got[i].score - 1 / (1 + math.exp(-max(-50, min(50, z))))) < 0.02
        assert got[i].predicted == int(got[i].score >= 0.3)
    right = sum(got[i].predicted == label for i, _, label in rows)
    assert right >= len(rows) - 12
