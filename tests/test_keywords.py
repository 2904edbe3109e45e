"""The n-gram index against plain `contains`, and its plan."""

import contextlib
import io
import random

from pyspark.sql import functions as F

from modelyard.operators import discovery as D
from modelyard.operators import keywords as I
from modelyard.sources.views import CATEGORIES, view

SF = "/root/testdata/sf0.001"
LETTERS = "abcdeüÉ\U0001f642 -"


def texts(n=150):
    r = random.Random(1)
    rows = [(i, "".join(r.choice(LETTERS) for _ in range(r.randint(0, 40)))) for i in range(n)]
    return rows + [(n, None), (n + 1, "ab"), (n + 2, "".join(r.choice(LETTERS) for _ in range(30_000)))]


def brute(rows, words):
    low = [(i, t.lower()) for i, t in rows if t is not None]
    return sorted((i, w) for w in words if w is not None for i, t in low if w.lower() in t)


def test_hundred_thousand_keywords(spark):
    r = random.Random(2)
    words = {"", "a", "B", "ab", "Éa", "\U0001f642", "\U0001f642\U0001f642", "absent\n"}
    while len(words) < 100_000:
        words.add("".join(r.choice(LETTERS) for _ in range(r.choice([2, 4, 5, 6, 7]))))
    rows, words = texts(), [*words, None]
    keywords = spark.createDataFrame([(w,) for w in words], "keyword string").repartition(4)
    df = spark.createDataFrame(rows, "id int, body string").repartition(3)
    wanted = brute(rows, words)
    assert len(wanted) > 20_000
    for carried in (False, True):
        got = I.matches(df, ["id"], "body", keywords, carried=carried)
        assert sorted(map(tuple, got.select("id", "keyword").collect())) == wanted


def test_every_row_of_a_repeated_keyword_and_none_of_an_empty_table(spark):
    df = spark.createDataFrame([(1, "Ring gear")], "id int, body string")
    keywords = spark.createDataFrame([("x", "ring"), ("y", "RING"), ("z", "bolt")], "category string, keyword string")
    got = I.matches(df, ["id"], "body", keywords).collect()
    assert sorted(r.category for r in got) == ["x", "y"]
    assert I.matches(df, ["id"], "body", keywords.limit(0)).count() == 0
    assert I.matches(df.limit(0), ["id"], "body", keywords).count() == 0


def test_search_equals_the_one_with_keywords_in_the_plan(spark):
    models = view(spark, SF, "models")
    rows = D.category_keywords(CATEGORIES)
    table = spark.createDataFrame([(c, k, w) for c, _, k, w in rows], "category string, kw_ord int, keyword string")
    columns = ["category", "kw_ord", "rank", "model_id"]
    wanted = D.search_by_keyword(models, CATEGORIES, per_keyword=7).select(*columns)
    got = I.search(models, table, per_keyword=7).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect())) != []


def test_the_plan_holds_no_keyword(spark):
    keywords = spark.createDataFrame([(f"word{i}",) for i in range(2000)], "keyword string")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        I.matches(spark.range(5).withColumn("body", F.lit("a word77 b")), ["id"], "body", keywords).explain()
    assert "word1999" not in out.getvalue()
    for operator in ("CartesianProduct", "NestedLoop"):
        assert operator not in out.getvalue()


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_grams_are_not_broadcast(spark):
    keywords = spark.createDataFrame([("ring",)], "keyword string")
    df = spark.createDataFrame([(1, "Ring gear")], "id int, body string")
    for carried in (False, True):
        assert "SortMergeJoin [gram" in plan_of(I.matches(df, ["id"], "body", keywords, carried=carried))


def test_touched_by_small_and_large_tables(spark):
    rows = [(1, "Ring gear"), (1, "bolt"), (2, None), (3, "xyz"), (3, "xyz")]
    df = spark.createDataFrame(rows, "id int, body string")
    words = [(0, "ring"), (0, "GEAR"), (1, "b"), (1, None), (2, ""), (3, "none")]
    keywords = spark.createDataFrame(words, "cat int, keyword string")
    wanted = sorted({(i, c) for i, t in rows for c, w in words if t is not None and w is not None and w.lower() in t.lower()})
    for near in (0, 100):
        got = I.touched(df, ["id"], "body", keywords, ["cat"], near)
        assert sorted(map(tuple, got.collect())) == wanted
    assert "[gram" not in plan_of(got)
