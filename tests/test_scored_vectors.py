"""Answers meet the vectors of their own models only."""

from modelyard.operators import scoring as S
from modelyard.plans import scoring as PS

TABLES = {
    "documents": ("doc_id bigint, text string, lang string, source string, n_chars bigint",
                  [(i, f"text {i} of a model", "en", "web", 17) for i in range(4)]),
    "benchmark": ("item_id bigint, text string", [(i, f"item {i}") for i in range(3)]),
    "conversations": ("conv_id bigint, turn bigint, role string, text string",
                      [(c, t, r, f"{r} says {c}") for c in range(9) for t, r in ((1, "user"), (2, "assistant"))]),
    "embeddings": ("vec_id bigint, embedding array<float>, label int",
                   [(i, [float(i % 3), 1.0 + i, float(i % 2)], i % 10) for i in range(9)]),
}


def test_vectors_of_a_model_without_answers_are_not_matched(spark, tmp_path, monkeypatch):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    whole = S.embedding_f1(PS.view(spark, str(tmp_path), "token_vecs"), PS.BASELINE)
    wanted = PS.V.sample_scores(PS._samples(spark, str(tmp_path)), whole)
    met, match = [], S.embedding_f1

    def noted(vectors, *more):
        met.append(vectors)
        return match(vectors, *more)

    monkeypatch.setattr(S, "embedding_f1", noted)
    got = PS._scores(spark, str(tmp_path))
    models = {r.model_id for r in got.select("model_id").distinct().collect()}
    assert {r.model_id for r in met[0].select("model_id").distinct().collect()} == models
    assert models == {"m0", "m1", "m2"}
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
