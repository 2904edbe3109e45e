"""Language, toxicity and quality models: held-out results, edge rows, determinism."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.llm import features, language, quality_classifier, toxicity
from modelyard.llm.queries import QUERIES
from modelyard.sources.tables import table
from tests.llm import brute
from tests.llm.conftest import edge_texts, words

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_ngrams_never_span_texts(size):
    texts = ["abcdef", "", "ab", "x", "abcdefabc", "🙂é"]
    bins, at = features.ngram_bins(*features.code_points(texts), size, 30)
    for i, t in enumerate(texts):
        own = bins[at[i] : at[i + 1]]
        alone, _ = features.ngram_bins(*features.code_points([t]), size, 30)
        assert own.tolist() == alone.tolist() and len(own) == max(0, len(t) - size + 1)


def test_tokens_are_runs_of_one_kind():
    texts = ["ab, cd ab!!", "", "  ", "ab", "🙂 abあx", "cd"]
    bins, at = features.token_bins(*features.code_points(texts), 40)
    own = [bins[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert [len(x) for x in own] == [len(re.findall(r"\w+|[^\w\s]+", t)) for t in texts[:4]] + [2, 1]
    ab, cd = own[3][0], own[5][0]
    assert own[0][0] == own[0][3] == ab and own[0][2] == cd and own[0][1] not in (ab, cd)
    far = ["y" * 1000 + " ab"]
    assert features.token_bins(*features.code_points(far), 40)[0][1] == ab


def held(spark, name, label):
    got = QUERIES[name](spark, SF).collect()
    docs = table(spark, SF, "documents").count()
    assert len(got) == docs and all(0 <= r.score <= 1 for r in got)
    known = {r.doc_id: r[label] for r in table(spark, SF, "labels").collect()}
    return [(r, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]


def test_toxicity_on_held_out_rows(spark):
    pairs = held(spark, "op4_toxicity", "toxic")
    assert all(brute.crc_part(r.doc_id, 3) == 1 and r.predicted == int(r.score >= 0.7) for r, _ in pairs)
    caught = np.mean([r.predicted for r, y in pairs if y == 1])
    wrong = np.mean([r.predicted for r, y in pairs if y == 0])
    assert caught > 0.7 and wrong < 0.02, (caught, wrong)


def test_quality_on_held_out_rows(spark):
    pairs = held(spark, "op10_quality_classifier", "quality")
    assert all(brute.crc_part(r.doc_id, 5) == 0 and r.predicted == int(r.score >= 0.3) for r, _ in pairs)
    assert np.mean([r.predicted == y for r, y in pairs]) > 0.9


def test_language_on_held_out_rows(spark):
    got = QUERIES["op2_language"](spark, SF)
    known = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    rows = got.collect()
    assert len(rows) == len(known) and {r.lang_pred for r in rows} <= set(known.values()) | {"und"}
    out = [r.lang_pred == known[r.doc_id] for r in rows if r.held_out]
    assert all(brute.crc_part(r.doc_id, 4) == 2 for r in rows if r.held_out) and np.mean(out) > 0.97


def test_predictions_read_the_text_only(spark):
    """Other columns changed, nulls in labels, copies: same text, same result."""
    docs = table(spark, SF, "documents")
    learn = ~features.held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs, learn)
    text = docs.first().text
    odd = spark.createDataFrame([(None, text, None), (1, text, "xx")], "doc_id bigint, text string, Score string")
    a, b = language.predict(odd, model).collect()
    assert (a.lang_pred, a.score) == (b.lang_pred, b.score) and len(a) == 4


def test_language_by_hand(spark):
    """Nearest centroid of plainly computed vectors."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").filter("doc_id < 60")
    model = language.fit(docs, F.lit(True))
    names = model.predict([r.text for r in docs.collect()])[0]
    for r, name in zip(docs.collect(), names):
        x = np.log1p(language.counts([r.text])[0]) * model.idf
        cosines = model.centroids @ x / (np.linalg.norm(x) or 1)
        assert model.languages[model.owner[int(cosines.argmax())]] == name
    far = model.predict(["0123 4567 " * 50])[2]
    assert far[0]


def test_edge_rows(spark, edge_docs, no_docs):
    n = len(edge_texts())
    learn = F.lit(True)
    guess = language.predict(edge_docs, language.fit(edge_docs, learn)).collect()
    assert len(guess) == n
    for r in guess:
        t = edge_texts()[r.doc_id]
        assert (r.lang_pred == "und") == (not t or not re.search(r"[^\W\d_]", t))
        assert r.lang_pred != "und" or r.score == 0
    labels = spark.createDataFrame(
        [(i, i % 2, (i // 2) % 2) for i in range(n)] + [(5, None, None), (None, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    clash = edge_docs.withColumn("SCORE", F.lit("x")).withColumn("text_to_read", F.lit("y"))
    for module, label in ((toxicity, "toxic"), (quality_classifier, "quality")):
        model = module.fit(edge_docs, labels, learn, label)
        scored = module.score(clash, model)
        assert scored.columns.count("score") == 1 and "SCORE" not in scored.columns
        rows = {r.doc_id: r.score for r in scored.collect()}
        assert len(rows) == n and all(0 <= s <= 1 for s in rows.values())
        assert rows[0] == rows[1]  # null and empty
        assert rows[5] == pytest.approx(rows[6], abs=1e-12)  # copies
        one_kind = module.fit(edge_docs, labels.filter(f"{label} = 1"), learn, label)
        assert {r.score > 0.99 for r in module.score(edge_docs, one_kind).collect()} == {True}
        assert module.score(no_docs, module.fit(no_docs, labels.limit(0), learn, label)).count() == 0
    assert language.fit(no_docs, learn) is None
    assert {r.lang_pred for r in language.predict(edge_docs, None).collect()} == {"und"}


def test_presence_equals_sets():
    texts = ["the scum the", "", "scumbag x", "ab"]
    found, ends = toxicity.presence(texts)
    for i, t in enumerate(texts):
        own = set()
        for size in toxicity.SIZES:
            own |= set(features.ngram_bins(*features.code_points([t]), size, toxicity.BITS)[0].tolist())
        assert set(found[ends[i] : ends[i + 1]].tolist()) == own


def test_neighbour_sums_equal_loops():
    import pyarrow as pa

    texts = [" ".join(words(i, 30)) for i in range(5)] + ["", None, "one"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    (out,) = quality_classifier.neighbour_sums([batch])
    place, sign = quality_classifier.index_vectors()
    wanted = {}
    for t in texts:
        bins, _ = features.token_bins(*features.code_points([t or ""]), quality_classifier.BITS)
        for i, b in enumerate(bins):
            v = wanted.setdefault(b, np.zeros(quality_classifier.DIM))
            for j in range(max(0, i - 2), min(len(bins), i + 3)):
                if j != i:
                    np.add.at(v, place[bins[j]], sign[bins[j]])
    got = {b: np.array(v) for b, *v in zip(*[c.to_pylist() for c in out.columns])}
    for b, v in wanted.items():
        assert np.array_equal(got.get(b, np.zeros(len(v))), v)


def test_refit_gives_the_same_model(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    learn = ~features.held_out(F.col("doc_id"), 3, 1)
    a = toxicity.fit(docs, labels, learn)
    b = toxicity.fit(docs.repartition(5), labels.repartition(2), learn)
    assert np.array_equal(a.keep, b.keep) and np.allclose(a.weight, b.weight, atol=1e-9)


def test_languages_of_few_texts_in_many_copies(spark):
    """Each language gets its share of the sample, however the copies' texts hash."""
    made = [(" ".join(words(seed, 40)),) for seed in range(400, 440)]
    high = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(1 << 20))  # the old sample left the highest out
    texts = [r.text for r in spark.createDataFrame(made, "text string").orderBy(high.desc()).limit(2).collect()]
    few = spark.createDataFrame([(t, "few") for t in texts], "text string, lang string")
    many = spark.createDataFrame([("zu wem " + " ".join(words(k, 9)), "many") for k in range(40)], "text string, lang string")
    docs = few.unionByName(many).crossJoin(spark.range(10_000).withColumnRenamed("id", "k"))
    docs = docs.filter("lang = 'few' OR k < 250").withColumn("doc_id", F.xxhash64("text", "k")).drop("k")
    model = language.fit(docs, F.lit(True))
    assert model.languages == ["few", "many"] and model.predict(texts)[0] == ["few", "few"]
    rows = docs.withColumn("h", F.xxhash64("doc_id", "text"))
    for n in (50, 3000):
        for parts in (rows.repartition(2), rows.repartition(7)):
            got = language._sample(parts, n).groupBy("lang", "text").count().collect()
            assert {k: sum(r["count"] for r in got if r.lang == k) for k in ("few", "many")} == {"few": n, "many": n}
            assert {r.text for r in got if r.lang == "few"} == set(texts)
    alike = few.limit(1).crossJoin(spark.range(500)).drop("id").withColumn("h", F.lit(5).cast("bigint"))
    assert language._sample(alike, 30).count() == 30  # repeated rows tie


def test_more_than_a_thousand_languages(spark):
    """1,200 languages of a few texts each; every one is learned and found again."""
    r = random.Random(12)
    rows = []
    for k in range(1200):
        letters = r.sample("abcdefghijklmnopqrstuvwxyzäöüßéèêàùçñåøæþðłśżźčřž", 7)
        texts = [" ".join("".join(r.choices(letters, k=r.randint(2, 7))) for _ in range(60)) for _ in range(2)]
        rows += [(t, f"l{k:04}") for t in texts]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    model = language.fit(df, F.lit(True))
    assert len(model.languages) == 1200
    got = language.predict(df.withColumnRenamed("lang", "known"), model).collect()
    assert sum(x.known == x.lang_pred for x in got) > 0.98 * len(got)
