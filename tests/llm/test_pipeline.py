"""Every stage of the pipeline against what its operator's brute-force version does."""

import hashlib

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from modelyard.llm import pii, quality_rules
from tests.llm import brute
from tests.llm.conftest import edge_texts, words

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [(10_000 + i, t, None, None, None) for i, t in enumerate(edge_texts())]
        + [(None, "a null id " * 10, "en", "z", 1)],
        docs.schema,
    )
    docs = docs.unionByName(extra).unionByName(docs.limit(5))  # the last are repeated rows
    tables = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{number}"
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
        tables.append([r.asDict() for r in docs.collect()])
    first = spark.read.parquet(f"{SF}/documents.parquet").unionByName(extra).unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").limit(5)
    )
    judged = quality_rules.judge(first)
    kept, clean, masked, mixed, encoded = tables
    # 7: only what the rules keep, the base limits by brute force
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(r.doc_id) for r in judged.filter("kept").collect())
    assert not any(brute.rule_row(r["text"])[-1] for r in kept)
    # 9: one row of each group, none of another group lost
    known = [r for r in kept if r["doc_id"] is not None]
    low = brute.components(len(known), brute.similar_pairs([r["text"] for r in known]))
    groups = {}
    for r, g in zip(known, low):
        groups.setdefault(g, set()).add(r["doc_id"])
    assert sorted(r["doc_id"] for r in clean if r["doc_id"] is not None) == sorted(min(g) for g in groups.values())
    # 3: every document, without personal data
    assert sorted(str(r["doc_id"]) for r in masked) == sorted(str(r["doc_id"]) for r in clean)
    text = {r["doc_id"]: r["text"] for r in clean}
    assert all(not brute.base_spans(r["text"]) for r in masked)
    assert all(r["text"] == text[r["doc_id"]] for r in masked if not brute.base_spans(text[r["doc_id"]]) and "[" not in r["text"])
    # 5: words per source as targeted, no document more than three times
    sizes, taken, per_doc = {}, {}, {}
    for r in masked:
        sizes[r["source"]] = sizes.get(r["source"], 0) + brute.size(r["text"])
    for r in mixed:
        taken[r["source"]] = taken.get(r["source"], 0) + brute.size(r["text"])
        per_doc[r["doc_id"]] = per_doc.get(r["doc_id"], 0) + brute.size(r["text"])
    assert all(abs(taken.get(s, 0) - t) <= 1 for s, t in brute.targets(sizes).items())
    size = {r["doc_id"]: brute.size(r["text"]) for r in masked}
    assert all(n <= 3 * size[i] for i, n in per_doc.items())
    # 8: the library's ids of every mixed row
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    wanted = sorted((str(r["doc_id"]), library.encode(r["text"], add_eos=True)) for r in mixed)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in encoded) == wanted
    assert all(r["n_tokens"] == len(r["ids"]) for r in encoded)


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF).select("doc_id", F.md5(F.array_join("ids", " ")).alias("m")).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    again = docs.select("doc_id", F.md5(F.array_join("ids", " ")).alias("m")).collect()
    assert sorted(rows) == sorted(again) and rows
    assert hashlib.md5(b"2").hexdigest() not in {r.m for r in rows}  # no empty rows


def test_stages_take_empty_tables(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_masking_leaves_clean_text_alone(spark):
    df = spark.createDataFrame([("no data here 12 34",)], "text string")
    assert pii.mask(df).first().text == "no data here 12 34"


def test_near_duplicates_lose_no_document_without_a_copy(spark):
    a, b, c, d, e = (" ".join(words(seed, 80)) for seed in range(50, 55))
    rows = [
        (None, a, "en", "s", 1),
        (None, b, "en", "s", 2),
        (7, c, "en", "s", 3),  # one id with two texts
        (7, d, "en", "s", 4),
        (7, c, "en", "s", 3),  # a repeated row
        (3, d, "en", "s", 5),  # a copy of the second text only; the least id stays
        (9, d + " tail", "en", "s", 6),
        (8, e, "en", "s", 7),
    ]
    wanted = [(None, a), (None, b), (3, d), (7, c), (8, e)]
    shared = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for docs, left in ((shared, wanted), (shared.filter("doc_id IS NULL OR doc_id <> 7"), wanted[:3] + wanted[4:])):
        got = corpus_pipeline.near_duplicates(spark, docs.repartition(3), SF)
        assert got.columns == COLUMNS
        assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted((str(i), t) for i, t in left)
