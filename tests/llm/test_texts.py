"""Personal data, quality rules and piece encoding against brute force."""

import itertools
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from modelyard.llm import pii, piece_encoding, quality_rules
from modelyard.llm.queries import tokenizer_model
from tests.llm import brute
from tests.llm.conftest import edge_texts

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
PII_TEXTS = [
    "mail a.b+c@x-y.example.com, then d@e.f_g@h.i and a@b c@d.",
    "1.2.3.4.5.6.7.8 999.1.2.3 1.2.3 010.0.0.001 1.2.3.256",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111111 4111  1111",
    "+1 (462) 555-7216 +4.5 +44 20 7946 0958- +123456789012345678 ++49(0)30-1234567",
    "+1 10.20.30.40 555 é 4962251213359604 x",
    "iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432; DE89370400440532013001",
    "ssn 123-45-6789" + " blah" * 20 + " order 219-45-6780" + " blah" * 20 + " social security 000-12-3456",
]


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_base_spans(spark):
    texts = edge_texts() + PII_TEXTS
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = pii.find(df)
    for r in found.collect():
        mine = [(s.kind, s.start, s.end) for s in r.pii_spans if s.kind in pii.BASE_KINDS]
        assert mine == brute.base_spans(texts[r.doc_id]), texts[r.doc_id][:200]
        for s in r.pii_spans:
            assert texts[r.doc_id][s.start : s.end] == s.value and 0 <= s.score <= 1


def test_random_spans(spark):
    random.seed(3)
    alphabet = list("12345 .-+()@ab") + ["4111111111111111", "1.2.3.4", "@x.y", "+1 "]
    texts = ["".join(random.choices(alphabet, k=random.randint(1, 60))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in pii.find(df).collect():
        mine = [(s.kind, s.start, s.end) for s in r.pii_spans if s.kind in pii.BASE_KINDS]
        assert mine == brute.base_spans(r.text), r.text


def test_added_kinds_need_checksum_and_context(spark):
    df = spark.createDataFrame([(t,) for t in PII_TEXTS[-2:]], "text string")
    kinds = [[(s.kind, s.value) for s in r.pii_spans] for r in pii.find(df).collect()]
    assert ("iban", "DE89 3704 0044 0532 0130 00") in kinds[0]
    assert ("iban", "GB82WEST12345698765432") in kinds[0]
    assert "DE89370400440532013001" not in [v for _, v in kinds[0]]
    assert [v for k, v in kinds[1] if k == "national_id"] == ["123-45-6789"]


def test_mask_keeps_columns_and_leaves_nothing(spark, edge_docs, no_docs):
    df = spark.createDataFrame(
        [(t, "x") for t in PII_TEXTS] + [(None, "y")], "text string, pii_spans string"
    )
    masked = pii.mask(df)
    assert masked.columns == df.columns
    texts = [r.text for r in masked.collect()]
    assert texts[-1] is None
    assert texts[4] == "[PHONE] é [CARD] x"
    assert not pii.find(masked.select("text")).filter(F.size("pii_spans") > 0).count()
    assert pii.mask(no_docs).count() == 0 and pii.mask(edge_docs).count() == len(edge_texts())


def test_rule_signals(spark):
    random.seed(5)
    more = [" ".join(random.choices(["a", "b", "c#", "d\n"], k=random.randint(0, 80))) for _ in range(300)]
    texts = edge_texts() + more
    df = spark.createDataFrame(
        [(i, t, "old") for i, t in enumerate(texts)], "doc_id bigint, text string, KEPT string"
    )
    judged = quality_rules.judge(df)
    assert judged.columns.count("kept") == 1 and "KEPT" not in judged.columns
    base = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    for r in judged.collect():
        text = texts[r.doc_id]
        assert tuple(r[c] for c in base) == brute.rule_row(text), text
        assert 0 <= r.quality <= 1 and r.kept == (not r.base_failed and r.quality >= 0.5)


def test_rules_on_an_empty_table(no_docs):
    assert quality_rules.judge(no_docs).count() == 0


RULES = [n for group in quality_rules.FACTORS.values() for n in group]
CLEAN = (2,) * len(RULES)


def votes_with(**changed):
    return tuple(changed.get(n, v) for n, v in zip(RULES, CLEAN))


def test_expectation_maximisation_finds_the_classes():
    """Votes drawn from known rates: defects of bad documents and the classes are found."""
    r = random.Random(1)
    found = {"length": 0.3, "symbols": 0.5, "lines": 0.4, "word_length": 0.3, "marks": 0.35}  # on bad documents
    counts, right, n = {}, {}, 40_000
    for _ in range(n):
        good = r.random() < 0.85
        votes = votes_with(
            **{k: 0 for k, share in found.items() if r.random() < (0.001 if good else share)},
            **({"repeats": 1} if r.random() < (0.01 if good else 0.2) else {}),
        )
        counts[votes] = counts.get(votes, 0) + 1
        right.setdefault(votes, []).append(good)
    model = quality_rules.expectation_maximisation(list(counts.items()), RULES)
    assert abs(model.prior - 0.85) < 0.06
    for rule in ("length", "symbols", "word_length"):
        good, bad = model.rates[rule][(0,)]
        assert abs(bad - found[rule]) < 0.12 and 0.0005 < good < 0.003
    agree = sum(sum(g == (model.posterior(RULES, v) > 0.5) for g in goods) for v, goods in right.items())
    assert agree / n > 0.97


def test_one_rare_defect_outweighs_what_other_rules_do_not_see():
    """A defect that meets no other one is not learned as a harmless trait."""
    counts = {CLEAN: 9400, votes_with(symbols=0): 250, votes_with(marks=0): 300, votes_with(length=0): 50}
    model = quality_rules.expectation_maximisation(list(counts.items()), RULES)
    assert [model.posterior(RULES, v) > 0.5 for v in counts] == [True, False, False, False]


def test_the_posterior_outvotes_a_bad_vote():
    """Where bad documents show overlapping defects, one lone other vote is outvoted by the rest."""
    loud = votes_with(symbols=0, upper=0, marks=0)
    worst = votes_with(symbols=0, upper=0, marks=0, length=0)
    lone, symbols, both = votes_with(word_length=0), votes_with(symbols=0), votes_with(word_length=0, symbols=0)
    counts = {CLEAN: 8000, loud: 900, worst: 300, lone: 60, symbols: 50, both: 20}
    model = quality_rules.expectation_maximisation(list(counts.items()), RULES)
    verdict = {v: model.posterior(RULES, v) for v in counts}
    assert verdict[CLEAN] > verdict[lone] > 0.5 > verdict[symbols] > verdict[both] > verdict[worst]


def test_overlapping_rules_count_once():
    """Two rules that always speak together are one factor: less than twice the evidence."""
    counts = {CLEAN: 9000, votes_with(upper=0, marks=0): 400, votes_with(symbols=0): 400}
    model = quality_rules.expectation_maximisation(list(counts.items()), RULES)
    alone = model.weight("symbols", (0,))
    assert abs(model.weight("shouting", (0, 0))) < 1.9 * abs(alone)
    rates = [x for keys in model.rates.values() for pair in keys.values() for x in pair]
    assert all(0 < x < 1 for x in rates)


def test_kept_equals_a_plain_count_of_votes(spark, edge_docs):
    """The verdict recomputed in Python from the signals, for every row."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(edge_docs).drop("lang", "source")
    judged = quality_rules.judge(docs).collect()
    votes = []
    for s in judged:
        n, chars = s.n_words, s.word_chars
        votes.append(
            tuple(
                {
                    "length": 0 if n < 20 else 2 if n >= 50 else None,
                    "symbols": 0 if s.n_symbols * 10 > n else 1 if s.n_symbols * 50 > n else 2,
                    "lines": 0 if s.n_dup_lines * 2 > s.n_lines else 1 if s.n_dup_lines * 3 > s.n_lines else 2 if s.n_lines > 1 else None,
                    "repeats": 0 if s.n_repeat_words * 100 > n * 30 else 1 if s.n_repeat_words * 10 > n else 2 if n >= 50 else None,
                    "word_length": 0 if chars < 2 * n or chars > 14 * n else 1 if chars < 3 * n or chars > 10 * n else 2,
                    "upper": 0 if s.n_upper * 10 > chars * 4 else 1 if s.n_upper * 10 > chars * 2 else 2,
                    "marks": 0 if s.n_marks * 4 > n else 1 if s.n_marks * 20 > n else 2,
                }[k]
                for k in RULES
            )
        )
    counts = {v: votes.count(v) for v in set(votes)}
    model = quality_rules.expectation_maximisation(sorted(counts.items(), key=str), RULES)
    for s, v in zip(judged, votes):
        wanted = model.posterior(RULES, v)
        assert abs(s.quality - wanted) < 1e-6 and s.kept == (not s.base_failed and wanted >= 0.5)


def test_encoding_equals_the_library(spark):
    random.seed(2)
    pieces = [LIBRARY.id_to_piece(i) for i in range(300, 32000, 7)]
    alphabet = list(" ▁\n\tabé.,!<>s/0🙂\x00\x01") + ["  ", "the", "ing"]
    made = ["".join(random.choices(alphabet, k=random.randint(0, 30))) for _ in range(2000)]
    made += ["".join(random.choices(pieces, k=5)).replace("▁", " ") for _ in range(2000)]
    texts = edge_texts() + made
    df = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(texts)],
        "doc_id bigint, text string, text_to_encode string, IDS int",
    ).repartition(3)
    done = piece_encoding.encode(df, tokenizer_model())
    assert done.columns == ["doc_id", "text_to_encode", "ids", "decoded"]
    for r in done.collect():
        wanted = LIBRARY.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.ids == wanted and r.decoded == LIBRARY.decode(wanted)


def test_decoding_any_ids_equals_the_library():
    random.seed(4)
    codec = piece_encoding.codec(tokenizer_model())
    for _ in range(3000):
        ids = [random.choice([random.randrange(32000), random.randrange(259)]) for _ in range(random.randint(0, 9))]
        ids = [i for i in ids if i]  # the unknown id stands for no text
        assert codec.decode(ids) == LIBRARY.decode(ids), ids


def test_backtracking_on_all_short_words():
    codec = piece_encoding.codec(tokenizer_model())
    for letters in itertools.product("aehinst", repeat=5):
        word = "".join(letters)
        assert codec.encode(word).tolist()[:-1] == LIBRARY.encode(word)


def test_encoding_an_empty_table(no_docs):
    assert piece_encoding.encode(no_docs, tokenizer_model()).count() == 0


@pytest.mark.parametrize("name", ["op3_pii", "op7_quality_rules", "op8_piece_encoding"])
def test_query_has_a_row_per_document(spark, name):
    from modelyard.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert QUERIES[name](spark, sf).count() == n
