"""Shapes of the physical plans that must hold whatever the size of the tables."""

import contextlib
import io

import pytest

from modelyard.plans.catalog import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def plan(spark):
    """Static plan with automatic broadcasts off, as for large tables."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)

    def get(name):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            queries()[name](spark, SF).explain()
        return out.getvalue()

    yield get
    for k, v in old.items():
        spark.conf.set(k, v)


PYTHON = ("EvalPython", "InPandas", "InArrow")
JVM_ONLY = [
    "D1_category_dimension", "D14_all_categories", "D15_ranked_report", "M2_architecture",
    "M4_layer_groups", "E13_pairwise_verdict", "S3_item_projection", "S6_response_mask",
    "S7_packed_windows", "S8_length_batches", "S9_loop_decisions", "R2_request_latency",
    "R3_throughput", "R6_model_card", "R7_leaderboard",
]
KERNELS = ["M6_slerp", "M10_ties", "M13_dare_ties", "M16_low_rank_merge", "E7_bertscore_f1", "E17_summary"]


@pytest.mark.parametrize("name", JVM_ONLY + KERNELS)
def test_no_pairs_of_everything_and_no_forced_broadcast(plan, name):
    text = plan(name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange"):
        assert operator not in text, operator
    assert any(p in text for p in PYTHON) == (name in KERNELS)


def test_keyword_cut_happens_before_the_shuffle(plan):
    text = plan("D2_keyword_top_n")
    assert "row_number(), 50, Partial" in text


@pytest.mark.parametrize("name,models", [("M6_slerp", 2), ("M13_dare_ties", 4)])
def test_each_model_is_read_once(plan, name, models):
    assert plan(name).count("FileScan parquet") == models


@pytest.mark.parametrize("name", ["M8_trim_by_magnitude", "M9_sign_election", "M10_ties"])
def test_trimming_joins_the_models_once(plan, monkeypatch, name):
    from modelyard.operators import merging

    joins = []
    real = merging.aligned
    monkeypatch.setattr(merging, "aligned", lambda *a: joins.append(1) or real(*a))
    text = plan(name)
    assert len(joins) == 1  # and written: the plan reads no model again
    assert "embeddings.parquet" not in text and "joined-models" in text


def test_merge_of_a_stored_table_moves_no_weights(spark, plan):
    from modelyard.operators import merging
    from modelyard.sources import files
    from modelyard.sources.views import view

    spark.sql("DROP TABLE IF EXISTS stored_weights")
    files.save_params_table(view(spark, SF, "params"), "stored_weights", 4)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        merging.task_arithmetic(spark.table("stored_weights"), "m0", ["m1", "m2", "m3"]).explain()
    spark.sql("DROP TABLE stored_weights")
    assert "SortMergeJoin" in out.getvalue() and "Exchange" not in out.getvalue()
