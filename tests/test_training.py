import json

import random

import pytest
from pyspark.sql import functions as F

from modelyard.operators import synthetic as Y
from modelyard.operators.prefix import exclusive_running_total

REPLIES = [
    '[{"context":"c","question":"q","answer":"a"}]',
    'text [{"context":"c","question":"q","answer":"a"},\n {"context":"","question":"q","answer":"a"}] tail',
    "no json", "[1, null, true, \"s\", {\"answer\": false}]", '{"context":"c","question":"q"}', "5", "null",
    "[a] then [{}]", '[{"context":1,"question":null,"answer":true}]', "", None, "[]", '["a","b"]',
]


def brute(text):
    import re

    def load(t):
        try:
            return json.loads(t)
        except (json.JSONDecodeError, TypeError):
            return None

    value = load(text)
    if value is None and text and text != "null":
        m = re.search(r"\[.*\]", text, re.DOTALL)
        value = load(m.group()) if m else None
    rows = []
    for item in value if isinstance(value, list) else []:
        if isinstance(item, dict):
            rows.append(tuple(str(item.get(k, "")) for k in ("context", "question", "answer")))
    return rows


def test_json_extraction(spark):
    df = spark.createDataFrame([(i, t, "g") for i, t in enumerate(REPLIES)], "i int, raw string, gap_cat string")
    got = {i: [] for i in range(len(REPLIES))}
    for r in Y.synthetic_rows(df, "i").orderBy("i", "pos").collect():
        got[r.i].append((r.context, r.question, r.answer))
    assert got == {i: brute(t) for i, t in enumerate(REPLIES)}


def test_prompts(spark):
    df = spark.createDataFrame([("numerical",), ("else",)], "gap_cat string")
    got = {r.gap_cat: r.prompt for r in Y.gap_prompts(df, 9).collect()}
    assert got["numerical"].startswith("Generate 9 QA pairs involving numerical")
    assert '{"context": "...", "question"' in got["else"] and "factual recall" in got["else"]


@pytest.mark.parametrize("sparse", [False, True])
def test_running_total(spark, sparse):
    """Dense ids and 63-bit random ones; a group that holds two fifths of the rows."""
    n = 500
    r = random.Random(1)
    ids = sorted({r.getrandbits(63) for _ in range(n)}) if sparse else [i * 3 for i in range(n)]
    data = [(o, i % 7, 1 if i < 200 else i % 5) for i, o in enumerate(ids)]
    df = spark.createDataFrame(data, "o bigint, v int, g int")
    got = {r.o: r.t for r in exclusive_running_total(df.repartition(7), "o", "v", "t").collect()}
    total = 0
    for o, v, _ in data:
        assert got[o] == total
        total += v
    rows = sorted((g, o, v) for o, v, g in data)
    got = {r.o: r.t for r in exclusive_running_total(df, "o", "v", "t", "g").collect()}
    total = 0
    for _, o, v in rows:
        assert got[o] == total
        total += v


def test_packing_keeps_order_and_count(spark):
    texts = ["a b c", "", "d " * 17, "e", "f g"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "o bigint, text string")
    stream = " ".join(texts).split()
    got = Y.packed_windows(df.repartition(3), "o", 5).orderBy("window_id").collect()
    assert [w for r in got for w in r.text.split()] == stream
    assert [r.n_tokens for r in got] == [5] * (len(stream) // 5) + [len(stream) % 5][: len(stream) % 5]


def test_mask_uses_the_last_marker(spark):
    df = spark.createDataFrame(
        [(0, "<s>[INST] x [/INST] y [/INST] final words</s>"), (1, "no marker here"), (2, "")], "o int, text string"
    )
    rows = Y.response_mask(df, "o").collect()
    assert [r.token for r in rows if r.in_loss] == ["final", "words</s>"]
    assert sum(r.o == 1 for r in rows) == 3 and not any(r.o == 2 for r in rows)


def test_length_batches_with_one_hot_length(spark):
    df = spark.range(100).select(
        F.col("id").alias("o"), F.when(F.col("id") % 3 > 0, "a b c").otherwise(F.repeat(F.lit("w "), F.col("id").cast("int"))).alias("text")
    )
    got = Y.length_batches(df, "o").collect()
    rows = sorted((r.n_tokens, r.o) for r in got)
    assert {r.o: r.batch_id for r in got} == {o: i // 4 for i, (_, o) in enumerate(rows)}


def test_loop_decisions(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.2, 2, 5), (1, 2, 0.5, 2, 5), (1, 3, 0.9, 0, 0), (2, 1, 0.1, 0, 5), (3, 1, 0.1, 1, 0), (4, 1, 0.1, 1, 1), (4, 2, 0.2, 1, 1)],
        "loop_id int, iteration int, avg_rouge1 double, n_gaps int, n_syn int",
    )
    got = {r.loop_id: (r.stopped_at, r.reason, r.iterations, r.best_rouge1) for r in Y.loop_decisions(df).collect()}
    assert got == {
        1: (2, "target reached", 2, 0.5), 2: (1, "no gaps", 1, 0.1),
        3: (1, "no synthetic rows", 1, 0.1), 4: (None, "iterations used up", 2, 0.2),
    }


def test_windows_are_gathered_as_texts(spark, capsys):
    df = spark.createDataFrame([(1, "a b c"), (2, " d\te ")], "o int, text string")
    windows = Y.packed_windows(df, "o", 2)
    windows.explain()
    assert "flatten(" not in capsys.readouterr().out
    assert sorted(map(tuple, windows.collect())) == [(0, 2, "a b"), (1, 2, "c d"), (2, 1, "e")]
