"""A run that was killed goes on after its last finished stage."""

import pytest
from pyspark.sql import functions as F

from modelyard.plans.full_run import full_run
from modelyard.plans.manifest import Manifest, fingerprint
from modelyard.sources.views import CATEGORIES, view

SF = "/root/testdata/sf0.001"


class Killed(BaseException):
    pass


def start(spark, state, calls, kill=False, models=None, **more):
    def weights_of(ids):
        calls.append("weights")
        names = F.create_map(*[F.lit(x) for i, m in enumerate(ids) for x in (f"m{i}", m)])
        params = view(spark, SF, "params").withColumn("model_id", names[F.col("model_id")])
        return params.filter(F.col("model_id").isNotNull())

    def answers_of(model):
        calls.append("answers")
        return view(spark, SF, "samples").withColumn("model_id", F.lit(model))

    def replies_to(prompts):
        calls.append("replies")
        if kill:
            raise Killed
        return view(spark, SF, "llm_raw").join(prompts.select("gap_cat"), "gap_cat", "left_semi")

    return full_run(
        "code",
        view(spark, SF, "models") if models is None else models,
        view(spark, SF, "cards"),
        weights_of=weights_of,
        answers_of=answers_of,
        replies_to=replies_to,
        categories=CATEGORIES,
        state_path=state,
        **more,
    )


def test_a_killed_run_resumes_without_scoring_again(spark, tmp_path):
    state, calls = str(tmp_path / "state"), []
    with pytest.raises(Killed):
        start(spark, state, calls, kill=True)
    assert calls == ["weights", "answers", "replies"]
    calls.clear()
    run = start(spark, state, calls)
    assert calls == ["replies"]
    plain = start(spark, None, [])
    for name in ("scores", "gaps", "training_rows", "record"):
        one, two = getattr(run, name), getattr(plain, name)
        assert one.columns == two.columns and fingerprint(one) == fingerprint(two.to(one.schema)), name
    calls.clear()
    again = start(spark, state, calls)
    assert calls == [] and again.shortlist == run.shortlist
    assert {r.stage for r in Manifest(spark, state).lines().collect()} == {"candidates", "merged", "scores", "training"}

    # a parameter of scoring, the callables' inputs, or the registry's rows make their stages anew
    start(spark, state, calls, stem=False)
    assert calls == ["answers", "replies"]
    calls.clear()
    start(spark, state, calls, inputs="new answers")
    assert calls == ["weights", "answers", "replies"]
    calls.clear()
    models = view(spark, SF, "models")
    start(spark, state, calls, models=models.withColumn("likes", F.col("likes") + 1))
    assert calls == ["weights", "answers", "replies"]
    calls.clear()
    start(spark, state, calls, models=models.repartition(7).orderBy("likes"))
    assert calls == []


def test_a_stage_without_its_line_is_made_again(spark, tmp_path):
    state, built = Manifest(spark, str(tmp_path)), []

    def build():
        built.append(1)
        return spark.range(3)

    (tmp_path / "a-key").mkdir()
    (tmp_path / "a-key" / "part-0.parquet").write_text("cut off")
    for _ in range(2):
        assert state.stage("a", "key", build).count() == 3
    assert len(built) == 1
    state.stage("b", "key", build)
    state.stage("a", "other", build)
    assert len(built) == 3


def test_fingerprint_tells_rows_not_their_order(spark):
    df = spark.createDataFrame([(1, "a", [1.5]), (2, None, None), (2, None, None)], "i int, s string, v array<double>")
    assert fingerprint(df) == fingerprint(df.repartition(3))
    assert len({fingerprint(x) for x in (df, df.distinct(), df.limit(0), df.withColumn("i", F.col("i") + 1), None)}) == 5
    assert fingerprint(df) != fingerprint(df.withColumnRenamed("s", "t"))
