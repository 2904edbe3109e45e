"""Replies are asked for once, kept through a failure, and equal to plain calls."""

import pytest
from pyspark.sql import functions as F

from modelyard.operators import replies as M
from modelyard.operators.scoring import batched_call

ROWS = "id int, prompt string, reply string"


def maker(log, refuse=(), broken=None):
    """A model that notes every prompt it is asked in a file of its own."""

    def make():
        if broken and broken.exists():
            raise RuntimeError("no model")

        def call(prompts):
            import uuid

            if any(p in refuse for p in prompts):
                raise RuntimeError("refused")
            for p in prompts:
                (log / uuid.uuid4().hex).write_text(p)
            return [f" re: {p} " for p in prompts]

        return call

    return make


def asked(log):
    return sorted(f.read_text() for f in log.iterdir())


def test_only_unseen_prompts_are_asked_and_each_once(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    log.mkdir()
    rows = [(i, f"p{i % 7}", "old") for i in range(60)] + [(60, None, None), (61, None, "x"), (62, "bad", None), (63, "", None)]
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    make = maker(log, ("bad",))
    got = M.remembered_call(df, "prompt", "reply", make, "m", store)
    assert got.columns == ["id", "prompt", "reply"]
    plain = sorted(map(tuple, batched_call(df, "prompt", "reply", maker(tmp_path / "log", ("bad",)), 1).collect()), key=str)
    for f in log.iterdir():
        f.unlink()
    assert sorted(map(tuple, got.collect()), key=str) == plain
    assert asked(log) == []  # the frame reads the table
    more = spark.createDataFrame([(99, "new", None), (98, "p3", None)], ROWS)
    again = M.remembered_call(df.unionByName(more), "prompt", "reply", maker(log), "m", store)
    assert again.count() == 66
    assert asked(log) == ["bad", "new"]
    M.remembered_call(more, "prompt", "reply", maker(log), "other model", store)
    assert asked(log) == ["bad", "new", "new", "p3"]


def test_a_killed_run_keeps_its_waves(spark, tmp_path):
    log, store, flag = tmp_path / "log", str(tmp_path / "store"), tmp_path / "broken"
    log.mkdir()
    df = spark.createDataFrame([(i, f"p{i}", None) for i in range(40)], ROWS)
    first = df.filter(F.pmod(F.xxhash64(M.prompt_key("m", F.col("prompt"))), F.lit(4)) == 0)
    M.remembered_call(first, "prompt", "reply", maker(log), "m", store)
    done = asked(log)
    flag.write_text("")
    with pytest.raises(Exception):
        M.remembered_call(df, "prompt", "reply", maker(log, broken=flag), "m", store, waves=4)
    assert asked(log) == done
    flag.unlink()
    got = M.remembered_call(df, "prompt", "reply", maker(log, broken=flag), "m", store, waves=4)
    assert asked(log) == sorted(f"p{i}" for i in range(40))
    assert {r.prompt: r.reply for r in got.collect()} == {f"p{i}": f"re: p{i}" for i in range(40)}


def test_two_replies_to_one_prompt_give_one_row(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = spark.createDataFrame([(1, "p", None)], ROWS)
    key = rows.select(M.prompt_key("m", F.col("prompt")).alias("k")).first().k
    spark.createDataFrame([(key, "m", "b"), (key, "m", "a")], M.STORED).write.parquet(store)
    got = M.remembered_call(rows, "prompt", "reply", maker(tmp_path), "m", store)
    assert [r.reply for r in got.collect()] == ["a"]
    empty = M.remembered_call(rows.limit(0), "prompt", "reply", maker(tmp_path), "m", store)
    assert empty.count() == 0


def test_an_evaluation_run_again_asks_nothing(spark, tmp_path):
    from modelyard.operators import evaluation as V

    log, store = tmp_path / "log", str(tmp_path / "store")
    log.mkdir()
    rows = [("m", f"s{i}", i, f"context {i % 3}", "who?", "a b", "") for i in range(9)]
    samples = spark.createDataFrame(
        rows, "model_id string, sample_id string, ord int, context string, question string, reference string, prediction string"
    )
    plain = V.evaluate(samples, maker(tmp_path / "log"), maker(log), maker(log))[1]
    wanted = sorted(map(str, plain.collect()))
    for f in log.iterdir():
        f.unlink()
    for run in range(2):
        scores = V.evaluate(samples, maker(log), maker(log), maker(log), replies_path=store)[1]
        assert sorted(map(str, scores.collect())) == wanted
        assert len(asked(log)) == 9  # three prompts of each of three models


def test_rows_are_computed_once_a_call_and_once_for_the_result(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    log.mkdir()
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(i, f"p{i % 7}" if i % 5 else None, None) for i in range(40)]
    df = spark.createDataFrame(rows, ROWS).mapInArrow(counted, ROWS)
    M.remembered_call(df, "prompt", "reply", maker(log), "m", store)
    assert seen.value == 40
    again = M.remembered_call(df, "prompt", "reply", maker(log), "m", store)
    assert seen.value == 80
    wanted = [(i, p, p and f"re: {p}") for i, p, _ in rows]
    assert sorted(map(tuple, again.collect())) == wanted
    assert seen.value == 120
    assert asked(log) == sorted(f"p{i}" for i in range(7))
