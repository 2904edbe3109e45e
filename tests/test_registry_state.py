"""State plus changes against a full scan."""

import random

from pyspark.sql import functions as F

from modelyard.operators import discovery as D
from modelyard.operators import registry_state as Q

CATEGORIES = {"code": ["ab", "c"], "chat": ["b"], "none": ["zz"]}
MODEL = "model_id string, downloads bigint, task string, note string"
COLUMNS = ["category", "kw_ord", "rank", "model_id", "downloads", "note"]


def models(spark, registry):
    rows = [(m, d, "text-generation", note) for m, (d, note) in registry.items()]
    return spark.createDataFrame(rows, MODEL)


def hits(spark, registry):
    return D.matching_keywords(models(spark, registry), CATEGORIES)


def listed(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def full(spark, registry, n):
    return listed(D.search_by_keyword(models(spark, registry), CATEGORIES, per_keyword=n))


def test_state_and_changes_equal_a_full_scan(spark, tmp_path):
    r = random.Random(3)
    name = lambda: "".join(r.choice("abcd") for _ in range(4))
    registry = {name(): (r.choice([None, 0, 5, 5, 9, r.randrange(100)]), "old") for _ in range(120)}
    n, keep = 4, 8
    state = Q.state_of(hits(spark, registry), keep)
    assert listed(Q.top(state, n)) == full(spark, registry, n)
    scanned = 0
    for step in range(6):
        state.save(f"{tmp_path}/{step}")
        state = Q.State.load(spark, f"{tmp_path}/{step}", keep)
        assert max(x["count"] for x in state.rows.groupBy("category", "kw_ord").count().collect()) <= keep
        best = [x.model_id for x in Q.top(state, n).collect()]
        gone = set(r.sample(sorted(set(best)), 3)) | set(r.sample(sorted(registry), 2))
        change = {m: (r.randrange(100), f"step {step}") for m in r.sample(sorted(registry), 6)}
        change |= {name(): (r.randrange(120), "new") for _ in range(5)}
        if step == 3:  # everything that the state knows falls behind
            change |= {m: (0, "fallen") for m in {x.model_id for x in state.rows.collect()}}
        registry = {m: v for m, v in (registry | change).items() if m not in gone}
        now = {m: v for m, v in change.items() if m in registry}
        changed = spark.createDataFrame([(m,) for m in {*change, *gone}], "model_id string")
        state = Q.updated(state, changed, hits(spark, now))
        wanted = full(spark, registry, n)
        lost = {tuple(x) for x in Q.short(state, n).collect()}
        scanned += len(lost)
        assert listed(Q.top(state, n)) == [x for x in wanted if x[:2] not in lost]
        state = Q.refreshed(state, hits(spark, registry), n)
        assert listed(Q.top(state, n)) == wanted
    assert 0 < scanned < 12


def test_states_of_parts_merge(spark):
    r = random.Random(5)
    registry = {f"ab{i}c": (r.randrange(50), "x") for i in range(60)}
    parts = [{m: v for i, (m, v) in enumerate(registry.items()) if i % 2 == k} for k in range(2)]
    one, two = (Q.state_of(hits(spark, p), 10) for p in parts)
    both = Q.merged(one, two)
    assert listed(Q.top(both, 10)) == full(spark, registry, 10)
    empty = Q.state_of(hits(spark, registry).limit(0), 10)
    assert listed(Q.top(Q.merged(one, empty), 10)) == full(spark, parts[0], 10)
    assert Q.top(empty).count() == 0 and Q.short(empty).count() == 0
