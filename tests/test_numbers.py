import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.functions.kernels import round_bfloat16
from modelyard.functions.numbers import fixed, parse_float
from modelyard.operators import discovery as D

TEXTS = [
    "7", "7.", ".5", "+1.5", "-2e3", "1e-2", "7d", "7f", "0x1p3", "1_0", "1__0", "_1", "", " 8 ", "abc",
    "inf", "-Infinity", "nan", "1.5b", "1e", ".", "4_2.5_0",
]


def test_parse_float(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for row in df.select("t", parse_float(F.col("t")).alias("v")).collect():
        try:
            want = float(row.t)
        except ValueError:
            want = None
        if want is not None and math.isnan(want):
            assert math.isnan(row.v)
        else:
            assert row.v == want, row.t


def test_fixed_rounds_like_the_binary_value(spark):
    values = [0.125, 2.675, 1.005, 0.5, 1234567.891, -0.0625, 1e-9, 0.3749999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (1, 2, 3):
        for row in df.select("v", fixed(F.col("v"), places).alias("t")).collect():
            want = f"{row.v:.{places}f}"
            assert float(row.t) == float(want), (row.v, places)


def nearest_bf16(x):
    """Rounding by arithmetic: eight significant bits, exponent floor for subnormals."""
    if x == 0 or not np.isfinite(x):
        return np.float32(x)
    quantum = 2.0 ** (max(math.frexp(abs(float(x)))[1] - 1, -126) - 7)
    with np.errstate(over="ignore"):
        return np.float32(np.rint(float(x) / quantum) * quantum)


def test_bfloat16_matches_arithmetic_rounding():
    rng = np.random.default_rng(1)
    random_bits = rng.integers(0, 2**32, 4000, dtype=np.uint64).astype(np.uint32).view(np.float32)
    values = np.concatenate(
        [
            random_bits[np.isfinite(random_bits)],
            np.float32([2.0**e for e in range(-126, 128)]),
            np.float32([1 + 2**-8, 1 + 3 * 2**-8, 3.3961775e38, 1e-45, 1e-40, 0.0, -0.0, np.inf, -np.inf]),
        ]
    )
    np.testing.assert_array_equal(round_bfloat16(values), [nearest_bf16(v) for v in values])
    assert np.isnan(round_bfloat16(np.float32([np.nan]))).all()


def size_from_tags(tags):
    for tag in tags or []:
        low = tag.lower()
        for suffix in ("b", "b-instruct", "b-chat"):
            at = low.rfind(suffix)
            if at > 0:
                try:
                    return float(low[:at].rpartition("-")[2])
                except ValueError:
                    continue
    return None


def size_from_id(name):
    for token in re_split(name):
        if token.endswith("b"):
            try:
                return float(token[:-1])
            except ValueError:
                continue
    return None


def re_split(name):
    return name.lower().replace("-", " ").replace("_", " ").split()


MODELS = [
    ("org/llama-7b-chat", ["7B"]), ("a/x-13b", ["en", "4bit"]), ("a/b_70B", None), ("org/7b", []),
    ("q/base-1.5b-instruct", ["mistral-7b-instruct", "13b"]), ("bb/b", ["b", "bb", "3bb"]),
    ("n/none", ["web-2b-web", "x"]), ("t/8b 9b", ["a\nb-3b"]), ("k/1e1b-x", [".5b"]), ("z/nanb-nan", []),
    ("w/3b_2b", ["-b", "-5b-chat-b"]),
]


def test_sizes(spark):
    df = spark.createDataFrame(MODELS, "model_id string, tags array<string>")
    rows = df.select(
        "model_id", "tags",
        D.size_from_tags(F.col("tags")).alias("t"), D.size_from_id(F.col("model_id")).alias("i"),
    ).collect()
    for r in rows:
        assert r.t == size_from_tags(r.tags), r
        assert r.i == size_from_id(r.model_id) or math.isnan(r.i), r


def test_unknown_category_is_an_error():
    with pytest.raises(ValueError, match="Choose from"):
        D.category_keywords({"code": ["x"]}, ["nope"])


def test_size_gate_and_score_survive_nan(spark):
    df = spark.createDataFrame(
        [("a", float("nan")), ("b", 0.0), ("c", 10.0), ("d", 10.5), ("e", float("inf"))],
        "model_id string, params_b double",
    )
    kept = D.size_gate(df)
    assert {r.model_id for r in kept.collect()} == {"a", "b", "c"}
    scored = kept.selectExpr("*", "1 downloads", "1 likes", "0D card_quality").select(
        "model_id", D.composite_score().alias("s")
    )
    got = {r.model_id: r.s for r in scored.collect()}
    assert got == pytest.approx({"a": 0.0, "b": 0.06, "c": 0.2 * (1 - 3 / 7)})


def test_search_keeps_insertion_order_and_gates(spark):
    models = spark.createDataFrame(
        [
            ("o/alpha-7b", 5000, 50, "t", "text-generation", ["7b"]),
            ("o/alpha-beta-7b", 5000, 50, None, "text-generation", None),
            ("o/ALPHA-20b", 9000, 50, "t", "text-generation", ["20b"]),
            ("o/alpha-few", 10, 50, "t", "text-generation", []),
            ("o/alpha-null", None, None, "t", "text-generation", []),
            ("o/alpha-mask", 9000, 90, "t", "fill-mask", []),
        ],
        "model_id string, downloads bigint, likes bigint, pipeline_tag string, task string, tags array<string>",
    )
    cards = spark.createDataFrame([("o/alpha-7b", "x ## model details ## TRAINING")], "model_id string, card_text string")
    got = D.discover(models, cards, None, {"c": ["beta", "alpha"]}, ["c"], 5).orderBy("place").collect()
    assert [r.model_id for r in got] == ["o/alpha-7b", "o/alpha-beta-7b"]
    assert [r.kw_ord for r in got] == [1, 0]
    assert got[0].card_quality == 0.4 and got[1].pipeline_tag == "text-generation" and got[1].tags == []
