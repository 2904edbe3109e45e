"""Embedding links, the Jaccard join, components, mixing and URL rules against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.llm import embedding_links, jaccard_join, mixing, url_rules
from modelyard.llm.components import components
from modelyard.llm.queries import QUERIES, URL_RULES
from tests.llm import brute
from tests.llm.conftest import DOCS, edge_texts, words


def test_components(spark):
    random.seed(1)
    pairs = [(random.randrange(300), random.randrange(300)) for _ in range(200)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    wanted = brute.components(1100, pairs)
    got = {r.id: r.component for r in components(df).collect()}
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: wanted[x] for x in touched}
    assert components(df.limit(0)).count() == 0


def vectors():
    r = np.random.default_rng(3)
    base = r.normal(size=(40, 9))
    near = base[r.integers(0, 40, 260)] + r.normal(size=(260, 9)) * r.choice([0.01, 0.1, 0.2], (260, 1))
    rows = [(v.astype("float32").tolist(), int(i % 3)) for i, v in enumerate(np.vstack([base, near]))]
    rows += [(rows[0][0], rows[0][1])] * 30  # copies
    rows += [([x * 3 for x in rows[5][0]], rows[5][1])]  # same direction
    rows += [(None, 1), ([], 1), ([0.0] * 9, 1), ([math.nan] + [1.0] * 8, 1), ([math.inf] * 9, 1)]
    rows += [([None] + [1.0] * 8, 1), (rows[0][0], None), (rows[0][0][:5], 0), (rows[0][0][:5], 0)]
    return [(i * 2, v, label) for i, (v, label) in enumerate(rows)]


def test_embedding_links(spark):
    rows = vectors()
    schema = "vec_id bigint, embedding array<float>, label int, k1 string, Kept string"
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(4)
    got = {r.vec_id: r for r in embedding_links.link(df).collect()}
    assert len(got) == len(rows)

    def usable(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    pairs = []
    for i, (_, v, a) in enumerate(rows):
        for j in range(i + 1, len(rows)):
            _, w, b = rows[j]
            if usable(v, a) and usable(w, b) and a == b and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                    pairs.append((i, j))
    low = brute.components(len(rows), pairs)
    links = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    for i, (vec_id, _, _) in enumerate(rows):
        r = got[vec_id]
        assert (r.n_links, r.component_id, r.kept) == (links[i], 2 * low[i], low[i] == i), vec_id
        assert r.k1 == "x"
    assert embedding_links.link(df.limit(0)).count() == 0


def test_embedding_links_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(embedding_links, "TILE", 16)
    monkeypatch.setattr(embedding_links, "PER_CELL", 8)
    test_embedding_links(spark)


def test_visits_reach_every_cell_of_a_link():
    """No link lies in a cell that the traversal leaves out."""
    r = np.random.default_rng(5)
    x = embedding_links.unit(r.normal(size=(400, 8)), 8)
    y = embedding_links.unit(x + r.normal(size=x.shape) * 0.05, 8)
    books = embedding_links.fit_codebook(x[:, :4], 12), embedding_links.fit_codebook(x[:, 4:], 12)
    (_, b1), (_, b2) = embedding_links.bounds(x[:, :4], books[0]), embedding_links.bounds(x[:, 4:], books[1])
    (o1, _), (o2, _) = embedding_links.bounds(y[:, :4], books[0]), embedding_links.bounds(y[:, 4:], books[1])
    for i in range(len(x)):
        cells = embedding_links.traverse(b1[i], b2[i], 2 - 2 * 0.98 + 1e-9)
        costs = [b1[i][a] + b2[i][b] for a, b in cells]
        assert costs == sorted(costs)
        if x[i] @ y[i] >= 0.98:
            assert (o1[i], o2[i]) in cells


def test_recall_of_an_early_stop():
    """With a target below 1, links in random directions are still found as often."""
    r = np.random.default_rng(6)
    x = embedding_links.unit(r.normal(size=(1500, 64)), 64)
    step = r.normal(size=x.shape)
    step -= (step * x).sum(axis=1, keepdims=True) * x
    y = embedding_links.unit(x + 0.2 * step / np.linalg.norm(step, axis=1, keepdims=True), 64)
    books = embedding_links.fit_codebook(x[:, :32], 16), embedding_links.fit_codebook(x[:, 32:], 16)
    (_, b1), (_, b2) = embedding_links.bounds(x[:, :32], books[0]), embedding_links.bounds(x[:, 32:], books[1])
    (o1, _), (o2, _) = embedding_links.bounds(y[:, :32], books[0]), embedding_links.bounds(y[:, 32:], books[1])
    visits = {}
    for recall in (0.99, 1.0):
        limit = embedding_links.stop_at(0.98, recall, 64)
        cells = [set(embedding_links.traverse(b1[i], b2[i], limit)) for i in range(len(x))]
        assert np.mean([(o1[i], o2[i]) in c for i, c in enumerate(cells)]) >= recall
        visits[recall] = sum(map(len, cells))
    assert visits[0.99] < visits[1.0] / 2


def near_copies():
    r = random.Random(7)
    texts = []
    for g in range(25):
        base = words(100 + g, r.randint(6, 150))
        for _ in range(r.randint(1, 8)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 50))):
                w[r.randrange(len(w))] = r.choice(["new", "word", "here"])
            texts.append(" ".join(w))
    line = " ".join(words(999, 12))
    texts += [line + "\n" + " ".join(words(500 + i, 80)) for i in range(120)]
    texts += [texts[0]] * 20 + ["a  b c d e", "a b c d e"]
    return edge_texts() + texts


def check_join(spark, texts):
    docs = [(i * 3, t, "en", "s", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, DOCS).withColumn("rep", F.lit("r")).withColumn("N_links", F.lit("n"))
    got = {r.doc_id: r for r in jaccard_join.join(df.repartition(3)).collect()}
    assert len(got) == len(texts)
    real = [i for i, t in enumerate(texts) if brute.shingles(t)]
    first = {}
    for i in real:
        first.setdefault(texts[i], i)
    unique = sorted(first.values())
    pairs = [(unique[a], unique[b]) for a, b in brute.similar_pairs([texts[i] for i in unique])]
    copies = {i: sum(t == texts[i] for t in texts) for i in unique}
    links = {i: copies[i] - 1 for i in unique}
    for a, b in pairs:
        links[a] += copies[b]
        links[b] += copies[a]
    low = brute.components(len(texts), pairs)
    for i, t in enumerate(texts):
        r = got[3 * i]
        rep = first.get(t) if i in real else i
        assert r.class_id == 3 * rep
        assert r.n_links == (links[rep] if i in real else 0), (i, t)
        assert r.component_id == 3 * low[rep] and r.kept == (low[rep] == i) and r.rep == "r"
    return len(pairs)


def test_jaccard_join(spark):
    assert check_join(spark, near_copies()) > 30


def test_jaccard_join_splits_and_tiles(spark, monkeypatch):
    """The same with buckets that must be split, alike buckets and several tiles."""
    monkeypatch.setattr(jaccard_join, "TILE", 8)
    monkeypatch.setattr(jaccard_join, "TILE_SHINGLES", 300)
    full = jaccard_join.buckets
    monkeypatch.setattr(jaccard_join, "buckets", lambda s, runs: full(s, runs, small=4, levels=3))
    check_join(spark, near_copies())


def test_join_of_an_empty_table(no_docs):
    assert jaccard_join.join(no_docs).count() == 0


def test_runs_reach_the_target_recall():
    """Against trials of pairs that agree in a position with probability 0.8."""
    r = np.random.default_rng(8)
    agree = r.random((200_000, 64)) < 0.8

    def lost(share, levels):
        return 0 if levels == 0 else (1 - share + share * lost(share, levels - 1)) ** 2

    chances = np.array([lost(k / 64, 4) for k in range(65)])[agree.sum(axis=1)]
    for target in (0.99, 0.999):
        runs = jaccard_join.runs_needed(target)
        assert np.mean(chances**runs) <= (1 - target) * 1.1
        assert np.mean(chances ** (runs - 1)) > (1 - target) * 0.9
    assert jaccard_join.runs_needed() == 5


def test_sides_hold_every_pair_once(monkeypatch):
    monkeypatch.setattr(jaccard_join, "SIDE", 4)
    r = np.random.default_rng(2)
    for tile in ((1, 1), (0, 2)):
        block = r.choice(np.unique(tile), 30).astype(np.int32)
        sub = r.integers(0, 3, 30)
        seen = []
        for part in ((a, b) for a in range(3) for b in range(a, 3)):
            for a, b, pairs in jaccard_join._sides(block, tile, sub, part):
                i, j = np.nonzero(pairs)
                seen += [tuple(sorted(x)) for x in zip(a[i].tolist(), b[j].tolist())]
        wanted = [(i, j) for i in range(30) for j in range(i + 1, 30) if tile[0] == tile[1] or block[i] != block[j]]
        assert sorted(seen) == wanted


def mixed_docs(spark, n=400):
    r = random.Random(2)
    rows = []
    for i in range(n):
        source = None if i % 50 == 0 else f"s{min(r.randrange(9), 4)}" if i % 3 else "hot"
        rows.append((i, " ".join(["w"] * r.choice([0, 1, 5, 300, 2000])) if i % 40 else None, "en", source, 0))
    return rows, spark.createDataFrame(rows, DOCS).repartition(4)


def test_mix_takes_the_targets(spark):
    rows, df = mixed_docs(spark)
    got = mixing.allot(mixing.sizes(df)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + brute.size(t)
    wanted, taken = brute.targets(sizes), {}
    for r in got:
        assert r.size == brute.size(rows[r.doc_id][1]) and r.source_size == sizes[r.source]
        assert abs(r.target - wanted[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in wanted)
    again = mixing.allot(mixing.sizes(df.repartition(7))).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_by_tables_equals_the_mix_by_expressions(spark, monkeypatch):
    _, df = mixed_docs(spark)
    few = sorted(map(str, mixing.allot(mixing.sizes(df)).collect()))
    monkeypatch.setattr(mixing, "TREE_SOURCES", 2)
    assert sorted(map(str, mixing.allot(mixing.sizes(df)).collect())) == few


def test_mix_of_five_thousand_sources(spark):
    r = random.Random(6)
    rows = [(i, " ".join(["w"] * r.choice([0, 3, 40, 700])), "en", f"site {i % 5003}", 0) for i in range(7000)]
    rows += [(7000 + i, " ".join(["w"] * 900), "en", None, 0) for i in range(300)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    sizes, taken = {}, {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + brute.size(t)
    wanted = brute.targets(sizes)
    got = mixing.allot(mixing.sizes(df)).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.source_size == sizes[x.source] and abs(x.target - wanted[x.source]) < 1e-6 * max(1, x.target)
        assert 0 <= x.taken <= 3 * x.size
        taken[x.source] = taken.get(x.source, 0) + x.taken
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in wanted)


def test_mixed_rows_are_what_is_taken(spark):
    _, df = mixed_docs(spark)
    df = df.union(df.limit(30)).withColumn("row_size", F.lit("x"))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    wanted = {r.doc_id: r.t for r in mixing.allot(mixing.sizes(df)).groupBy("doc_id").agg(F.sum("taken").alias("t")).collect()}
    got = {r.doc_id: r.t for r in mixed.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("t")).collect()}
    assert got == {k: v for k, v in wanted.items() if v}


def test_schedule_is_even(spark):
    slots = mixing.schedule(spark, {0: 5000, 1: 20_000, 2: 0, 3: 75_001}, block=100).orderBy("slot").collect()
    served, total = {}, 0
    for n, s in enumerate(slots):
        served[s.source_no] = served.get(s.source_no, 0) + s.served
        total += s.served
        if n > 100:
            assert abs(served[3] / total - 0.75) < 0.03
    assert served == {0: 5000, 1: 20_000, 3: 75_001}
    assert all(s.served > 0 for s in slots)


def test_mix_of_nothing(spark, no_docs):
    assert mixing.allot(mixing.sizes(no_docs)).count() == 0 and mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "en", "a", 0), (2, " ", "en", None, 0)], DOCS)
    assert [r.taken for r in mixing.allot(mixing.sizes(blank)).collect()] == [0, 0]


URLS = [
    None, "", "x", "http://", "HTTP://EXAMPLE.ORG/es/1?x", "http://a.example.org/es", "ftp://xexample.org/es/",
    "http://org/", "http://org", "a://b.com/fr/x#y", "a://b.com/de/", "a://com/de/?q", "a://x.com/De/",
    "http://example.org/en/19", "http://example.org/en/2", "p://q://r.org/", "http://É.org/ü/", "http://h.org?a/b",
]


def test_url_parts_and_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS + URLS)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, HOST string")
    none = spark.createDataFrame([], "antecedent array<string>, confidence double, lift double, support double")
    got = url_rules.judge(df, URL_RULES, none).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = brute.url_row(r.url)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), r.url


def test_mined_rules(spark):
    """Rules equal those of counting all token sets up to the longest rule."""
    from itertools import combinations

    r = random.Random(4)
    urls = []
    for i in range(400):
        host = r.choice(["bad.net", "ok.net", "mix.net"])
        part = r.choice(["ads", "news"])
        blocked = host == "bad.net" or (host == "mix.net" and part == "ads")
        urls.append((f"http://{host}/{part}/{i}", blocked if r.random() < 0.95 else not blocked))
    df = spark.createDataFrame([*urls, (None, True), ("http://bad.net/", None)], "url string, blocked boolean")
    got = {tuple(x.antecedent): round(x.confidence, 9) for x in url_rules.mine(df, min_support=0.05).collect()}
    sets = [set(x[0]) for x in spark.createDataFrame(urls, "url string, b boolean").select(url_rules.tokens(F.col("url"))).collect()]
    total, base = {}, sum(b for _, b in urls) / len(urls)
    for s, (_, blocked) in zip(sets, urls):
        for k in range(1, len(s) + 1):  # rules of any length
            for c in combinations(sorted(s), k):
                n, y = total.get(c, (0, 0))
                total[c] = n + 1, y + blocked
    rules = {c: y / n for c, (n, y) in total.items() if y >= 0.05 * len(urls) and y / n >= 0.6 and y / n > base}
    kept = {
        c: round(v, 9)
        for c, v in rules.items()
        if not any(set(d) < set(c) and w >= v for d, w in rules.items())
    }
    assert got == kept and ("host:bad",) in got
    pages = spark.createDataFrame([(1, "http://bad.net/x"), (2, "http://ok.net/news/1"), (3, None)], "page_id bigint, url string")
    verdicts = {x.page_id: x.verdict for x in url_rules.judge(pages, [], url_rules.mine(df, min_support=0.05)).collect()}
    assert verdicts == {1: "block", 2: "allow", 3: "allow"}
    assert url_rules.mine(df.limit(0)).count() == 0


def test_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    for name, table in [("op1_embedding_links", "embeddings"), ("op5_mixing", "documents"), ("op6_url_rules", "pages"), ("op9_jaccard_join", "documents")]:
        assert QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/{table}.parquet").count()


@pytest.mark.parametrize("name", ["op1_embedding_links", "op9_jaccard_join"])
def test_check_sql(spark, name):
    from tests.oracle import compare, connect

    ok, note = compare(spark, connect("/root/testdata/sf0.001"), "/root/testdata/sf0.001", name)
    assert ok, note


@pytest.mark.parametrize("name", ["op5_mixing", "op6_url_rules"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))
