import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelyard import constants as K
from modelyard.functions import text as X
from modelyard.functions.stemming import porter
from modelyard.operators import scoring as S

# Word pairs printed in the paper that defines the algorithm, plus the
# departures named in the module.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size",
    "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz",
    "failing": "fail", "filing": "file", "happy": "happi", "relational": "relat",
    "conditional": "condit", "rational": "ration", "valenci": "valenc", "hesitanci": "hesit",
    "digitizer": "digit", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
    "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ",
    "angulariti": "angular", "homologous": "homolog", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "sky": "sky", "dying": "die", "flies": "fli",
    "dies": "die", "died": "die", "enjoy": "enjoy", "say": "say", "by": "by", "news": "news",
}


@pytest.mark.parametrize("word,stem", STEMS.items())
def test_stems(word, stem):
    assert porter(word) == stem


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@given(st.lists(st.sampled_from("abcd"), max_size=90), st.lists(st.sampled_from("abcd"), max_size=90))
def test_common_subsequence(a, b):
    assert X.common_subsequence(a, b) == brute_lcs(a, b)


def brute_tokens(text, stem):
    toks = [t for t in re.sub(r"[^a-z0-9]+", " ", text.lower()).split() if t]
    return [porter(t) if stem and len(t) > 3 else t for t in toks]


def brute_f(m, p, r):
    return 0.0 if m == 0 else 2 * (m / p) * (m / r) / (m / p + m / r)


def brute_rouge(pred, ref, stem):
    p, r = brute_tokens(pred, stem), brute_tokens(ref, stem)
    out = []
    for n in (1, 2):
        a = Counter(tuple(p[i : i + n]) for i in range(len(p) - n + 1))
        b = Counter(tuple(r[i : i + n]) for i in range(len(r) - n + 1))
        out.append(brute_f(sum((a & b).values()), sum(a.values()), sum(b.values())))
    return [*out, brute_f(brute_lcs(p, r), len(p), len(r))]


PAIRS = [
    ("The cats were running quickly", "A cat runs quick"),
    ("", "something"),
    ("!!!", "???"),
    ("same words here same", "same words here same"),
    ("a a a b", "a b b a a"),
    ("Über café naïve 3.14", "uber cafe naive 3 14"),
    ("one", "one"),
    ("x y z " * 400, "z y x " * 300),
]


@pytest.mark.parametrize("stem", [True, False])
def test_rouge_matches_brute_force(spark, stem):
    df = spark.createDataFrame(
        [("m", str(i), p, r) for i, (p, r) in enumerate(PAIRS)],
        "model_id string, sample_id string, prediction string, reference string",
    )
    got = {int(r.sample_id): r for r in S.rouge(df.repartition(5), stem).collect()}
    assert len(got) == len(PAIRS)
    for i, (p, r) in enumerate(PAIRS):
        want = brute_rouge(p, r, stem)
        assert [got[i].rouge1, got[i].rouge2, got[i].rougeL] == pytest.approx(want, abs=1e-12)


def test_rouge_symmetric_and_one_on_equal_text(spark):
    rows = [("m", "0", "a b c d", "b c x"), ("m", "1", "b c x", "a b c d"), ("m", "2", "q w e", "q w e")]
    df = spark.createDataFrame(rows, "model_id string, sample_id string, prediction string, reference string")
    got = {r.sample_id: (r.rouge1, r.rouge2, r.rougeL) for r in S.rouge(df).collect()}
    assert got["0"] == got["1"]
    assert got["2"] == (1.0, 1.0, 1.0)


HALL = [
    "It is DEFINITELY so", "definitely", "undefinitely", "100% sure", "100%x", "100%", "guaranteed!",
    "In 1921, it was invented here", "in 1921 the lamp\nwas invented", "in 99999 x invented",
    "in 2001,  discovered", "in 2001, a discovered b", "", "nobodyé", "ſure never", "in ٢٠٠١, a created",
    "a\rin 1999 a\rb founded",
]


def test_hallucination_patterns_match_regex_library(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(HALL)], "i int, t string")
    got = {r.i: r.h for r in df.select("i", X.hallucination_words(F.col("t")).alias("h")).collect()}
    for i, t in enumerate(HALL):
        want = any(re.search(p, t, re.IGNORECASE) for p in K.HALLUCINATION_PATTERNS)
        assert got[i] == want, t


JUDGE = {
    "SCORE: 7\nREASON:  fine \nmore": (7.0, "fine"),
    "SCORE:10": (10.0, ""),
    "SCORE: 99999999999999999999999": (10.0, ""),
    "SCORE: 007": (7.0, ""),
    "SCORE: 0": (0.0, ""),
    "score: 3": (5.0, ""),
    "SCORE: x SCORE: 4": (4.0, ""),
    None: (5.0, ""),
    "REASON: a REASON: b": (5.0, "a REASON: b"),
}


def test_judge_reply(spark):
    df = spark.createDataFrame([(t,) for t in JUDGE], "t string")
    rows = df.select("t", S.judge_score(F.col("t")).alias("s"), S.judge_reason(F.col("t")).alias("r"))
    for row in rows.collect():
        assert (row.s, row.r) == JUDGE[row.t], row.t


def test_embedding_f1_across_blocks(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(0)
    rows, want = [], {}
    for sample, (n, m) in enumerate([(3, 5), (1, 1), (23, 40)]):
        for model in ("a", "b"):
            p, r = rng.normal(size=(n, 6)), rng.normal(size=(m, 6))
            p[0] = 0 if sample == 2 else p[0]
            unit = lambda v: v / np.where(np.linalg.norm(v, axis=1, keepdims=True) == 0, 1, np.linalg.norm(v, axis=1, keepdims=True))
            c = unit(p) @ unit(r).T
            a, b = c.max(axis=1).mean(), c.max(axis=0).mean()
            want[model, sample] = 2 * a * b / (a + b)
            rows += [(model, sample, "pred", i, v.tolist()) for i, v in enumerate(p)]
            rows += [(model, sample, "ref", i, v.tolist()) for i, v in enumerate(r)]
    rows += [("a", 7, "ref", 0, [1.0] * 6), ("b", 8, "pred", 0, [1.0] * 6)]
    want["a", 7] = want["b", 8] = 0.0  # one side only
    df = spark.createDataFrame(rows, "model_id string, sample_id int, side string, pos int, vec array<double>")
    monkeypatch.setattr(S, "TOKEN_BLOCK", 4)
    got = {(r.model_id, r.sample_id): r.bertscore_f1 for r in S.embedding_f1(df).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_failed_calls_cost_their_rows_only(spark):
    def make():
        def call(prompts):
            if any("bad" in p for p in prompts):
                raise RuntimeError("no answer")
            if "short" in prompts:
                return prompts[:-1]
            return [None if p == "none" else f" {p}! " for p in prompts]

        return call

    prompts = ["a", "bad 1", "b", "none", "c", "short", "d", None, "bad 2"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prompts)], "i int, prompt string").coalesce(1)
    got = [r.reply for r in S.batched_call(df, "prompt", "reply", make).orderBy("i").collect()]
    assert got == ["a!", None, "b!", None, "c!", None, "d!", None, None]


def test_evaluate_runs_the_models(spark):
    from modelyard.operators import evaluation as V

    samples = spark.createDataFrame(
        [("m", str(i), i, f"context {i}", "who was it?", "it was me") for i in range(6)],
        "model_id string, sample_id string, ord int, context string, question string, reference string",
    )

    def generate():
        def call(prompts):
            if any("context 3" in p for p in prompts):
                raise RuntimeError
            return ["it was me" for _ in prompts]

        return call

    classify = lambda: lambda pairs: ["ENTAILMENT 0.9" if "[SEP] it" in p else "odd" for p in pairs]
    judge = lambda: lambda prompts: ["SCORE: 8 REASON: fine" if "it was me" in p.split("Prediction")[-1] else "" for p in prompts]
    summary, scores = V.evaluate(samples, generate, classify, judge, dataset="d")
    rows = {r.sample_id: r for r in scores.collect()}
    assert rows["0"].rouge1 == 1 and rows["0"].faithfulness == 0.9
    assert rows["3"].rouge1 == 0 and rows["3"].faithfulness == 0.5
    one = summary.first()
    assert (one.n_samples, one.dataset) == (6, "d")
    assert V.evaluate(samples, generate, classify)[1].first().judge_score == 5.0


def test_batched_call_makes_one_model_per_task(spark):
    def make():
        calls = []

        def call(prompts):
            calls.append(len(prompts))
            assert len(prompts) <= 4
            return [f" {p}:{sum(calls[:-1]) + i} " for i, p in enumerate(prompts)]

        return call

    df = spark.range(10).coalesce(1).selectExpr("cast(id as string) as prompt")
    got = sorted(r.reply for r in S.batched_call(df, "prompt", "reply", make).collect())
    assert got == sorted(f"{i}:{i}" for i in range(10))


def test_common_subsequence_of_very_long_lists():
    """20,000 by 20,000 tokens, against whole rows of the classic recurrence; and tiny blocks."""
    rng = np.random.default_rng(5)
    for words in (40, 3000):
        a, b = rng.integers(0, words, 20_000), rng.integers(0, words, 20_000)
        row = np.zeros(len(b), np.int32)
        for x in a:
            row = np.maximum.accumulate(np.where(b == x, np.append([0], row[:-1]) + 1, row))
        assert X.common_subsequence(a, b) == X.common_subsequence(b, a) == row[-1]
    for _ in range(300):
        a, b = (rng.integers(0, rng.choice([2, 5]), rng.integers(0, 90)) for _ in range(2))
        wanted = brute_lcs(a.tolist(), b.tolist())
        assert {X.common_subsequence(a, b, bits) for bits in (1, 5, 64, 8192)} == {wanted}


def test_a_huge_answer_is_compared_in_blocks(spark):
    """Blocks of five tokens give what whole answers give; no group is longer."""
    rng = np.random.default_rng(8)
    rows = []
    for sample, (n, m) in enumerate([(3, 4), (5, 5), (6, 2), (23, 1), (31, 17), (12, 0), (0, 40), (5, 6)]):
        for side, k in (("pred", n), ("ref", m)):
            rows += [("m", f"s{sample}", side, i, rng.normal(size=4).astype("float32").tolist()) for i in range(k)]
    df = spark.createDataFrame(rows, "model_id string, sample_id string, side string, pos bigint, vec array<float>")
    whole = {r.sample_id: r.bertscore_f1 for r in S.embedding_f1(df, 0.1).collect()}
    cut = {r.sample_id: r.bertscore_f1 for r in S.embedding_f1(df.repartition(5), 0.1, long=5).collect()}
    assert set(whole) == set(cut) and len(whole) == 8
    for k, v in whole.items():
        assert abs(cut[k] - v) < 1e-9


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_texts_are_cut_in_the_worker_and_prompts_in_portions(spark, capsys):
    df = spark.createDataFrame([("m", "1", "a", "b")], "model_id string, sample_id string, prediction string, reference string")
    assert "split(" not in plan_of(S.rouge(df), capsys)
    called = S.batched_call(df, "prediction", "reply", lambda: lambda prompts: list(prompts))
    assert "MapInArrow" in plan_of(called, capsys)


def test_rows_beyond_a_portion_keep_their_reply(spark):
    df = spark.range(3 * S.PORTION + 5).selectExpr("id", "IF(id % 7 = 0, NULL, concat('p', id)) AS prompt").coalesce(1)
    got = S.batched_call(df, "prompt", "reply", lambda: lambda prompts: [p + "!" for p in prompts]).collect()
    assert len(got) == 3 * S.PORTION + 5
    assert all(r.reply == (None if r.id % 7 == 0 else f"p{r.id}!") for r in got)


@given(st.text("abdeginsty", min_size=X.KEEPS_START, max_size=12))
def test_stems_of_longer_words_begin_like_the_word(word):
    assert porter(word)[:2] == word[:2]


def test_words_that_change_their_start_still_meet(spark):
    pairs = [("dying lying tying aings eing", "die lie tie a e"), ("die lie tie a e " * 3, "dying lying tying aings eing")]
    rows = [("m", str(i), p, r) for i, (p, r) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "model_id string, sample_id string, prediction string, reference string")
    got = {int(r.sample_id): (r.rouge1, r.rouge2, r.rougeL) for r in S.rouge(df).collect()}
    for i, (p, r) in enumerate(pairs):
        assert got[i] == pytest.approx(tuple(brute_rouge(p, r, True)))
