"""Weak supervision over quality rules, in DataFrame operations only.

Each rule votes good, doubtful or bad, or abstains. Rules that read the same trait vote
together, as one factor. Expectation-maximisation over the counts of vote patterns (at most
4^rules rows, whatever the corpus) estimates how often each factor casts its votes on good
and on bad documents, leaning on an opinion that weighs a stated number of documents; a
document is kept if its posterior probability of being good is at least one half and it does
not fail the two hard limits.

Defined results: a null or empty text has no words, fails the word limit and is not kept.
Ties and repeated rows: every row is judged by its own text only, so copies agree. An
empty table gives an empty table; the model is then the starting one. Extra columns pass
through; a column with a name that the operator adds is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.llm.text import NOT_SPACE, free_name, let, once, words
from modelyard.session import settled, written

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = r"[^#*$%&|<>]+"
SIGNALS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper n_marks".split()


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs at least twice.

    Positions of repeated windows come from one sort by (hash, position); each adds the
    words up to the next repeated window, eight at most.
    """
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(pairs: Column) -> Column:
        twice = F.filter(
            pairs,
            lambda p, k: (F.get(pairs, k - 1)["h"] == p["h"]) | (F.get(pairs, k + 1)["h"] == p["h"]),
        )
        return F.sort_array(F.transform(twice, lambda p: p["i"]))

    return let(
        ordered,
        lambda pairs: let(
            positions(pairs),
            lambda at: F.aggregate(
                F.transform(
                    at,
                    lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)),
                ),
                F.lit(0).cast("bigint"),
                lambda total, x: total + x,
            ),
        ),
    )


def _repeat_words(tokens: Column) -> Column:
    def window(hashes: Column) -> Column:
        firsts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
        return F.transform(
            firsts, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)])
        )

    return let(
        let(F.transform(tokens, lambda w: F.xxhash64(w)), window),
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(
            _covered(w)
        ),
    )


def signals(text: Column) -> Column:
    """Struct of the counts the rules read, from the whole text."""
    text = F.coalesce(text, F.lit(""))

    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_SPACE))
        return let(
            words(t),
            lambda w: let(
                lines,
                lambda rows: F.struct(
                    F.size(w).cast("bigint").alias("n_words"),
                    F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                    F.char_length(F.regexp_replace(t, SYMBOLS, "")).cast("bigint").alias("n_symbols"),
                    (F.size(rows) - F.size(F.array_distinct(rows))).cast("bigint").alias("n_dup_lines"),
                    _repeat_words(w).alias("n_repeat_words"),
                    F.size(rows).cast("bigint").alias("n_lines"),
                    F.char_length(F.regexp_replace(t, "[^A-Z]+", "")).cast("bigint").alias("n_upper"),
                    F.char_length(F.regexp_replace(t, "[^!?]+", "")).cast("bigint").alias("n_marks"),
                ),
            ),
        )

    return let(text, of)


BAD, DOUBTFUL, GOOD = 0, 1, 2


def _levels(bad: Column, doubtful: Column, good: Column | None = None) -> Column:
    """BAD, DOUBTFUL or GOOD; null abstains where good is told and does not hold."""
    vote = F.when(bad, BAD).when(doubtful, DOUBTFUL)
    return vote.otherwise(GOOD) if good is None else vote.when(good, GOOD)


def rules(s: Column) -> dict[str, Column]:
    """The rules, as votes over the signals."""
    n, chars, never = s["n_words"], s["word_chars"], F.lit(False)
    return {
        "length": _levels(n < MIN_WORDS, never, n >= 50),
        "symbols": _levels(s["n_symbols"] * 10 > n, s["n_symbols"] * 50 > n),
        "lines": _levels(s["n_dup_lines"] * 2 > s["n_lines"], s["n_dup_lines"] * 3 > s["n_lines"], s["n_lines"] > 1),
        "repeats": _levels(s["n_repeat_words"] * 100 > n * MAX_REPEAT_PERCENT, s["n_repeat_words"] * 10 > n, n >= 50),
        "word_length": _levels((chars < n * 2) | (chars > n * 14), (chars < n * 3) | (chars > n * 10)),
        "upper": _levels(s["n_upper"] * 10 > chars * 4, s["n_upper"] * 10 > chars * 2),
        "marks": _levels(s["n_marks"] * 4 > n, s["n_marks"] * 20 > n),
    }


#: Rules that read the same trait vote as one, by the combination of their votes.
FACTORS = {
    "length": ("length",),
    "symbols": ("symbols",),
    "repetition": ("lines", "repeats"),
    "word_length": ("word_length",),
    "shouting": ("upper", "marks"),
}
#: Opinion on one rule's votes before any data, on good and on bad documents, by vote.
OPINION = (
    {BAD: 0.001, DOUBTFUL: 0.01, GOOD: 0.889, None: 0.1},
    {BAD: 0.2, DOUBTFUL: 0.1, GOOD: 0.6, None: 0.1},
)
#: What the opinion weighs, in documents per document of the corpus. Rules are written to be
#: quiet on good documents, so that opinion is held strongly; it takes a rule that speaks on
#: a good part of the corpus to overrule it. Nothing is bounded.
WEIGHT = (10.0, 0.05)
START_PRIOR, PRIOR_WEIGHT = 0.9, 5.0
Votes = tuple[int | None, ...]


@lru_cache(maxsize=None)
def opinion(votes: Votes, k: int) -> float:
    """Of a factor's votes: its rarest vote speaks for all, as rules of one factor overlap."""

    def rarest(key: Votes) -> float:
        return min(OPINION[k][v] for v in key)

    return rarest(votes) / sum(map(rarest, product(OPINION[k], repeat=len(votes))))


@dataclass(frozen=True)
class LabelModel:
    """Prior of good, and per factor how often its votes come from good and from bad documents."""

    prior: float
    rates: dict[str, dict[Votes, tuple[float, float]]]

    def weight(self, factor: str, votes: Votes) -> float:
        """Log-odds of good that a factor's votes add."""
        good, bad = self.rates.get(factor, {}).get(votes) or (opinion(votes, 0), opinion(votes, 1))
        return math.log(good / bad)

    def logit(self, votes: dict[str, Column]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for factor, names in FACTORS.items():
            adds = None
            for key in product((BAD, DOUBTFUL, GOOD, None), repeat=len(names)):
                hit = reduce(lambda a, b: a & b, [votes[n].eqNullSafe(F.lit(v)) for n, v in zip(names, key)])
                adds = F.when(hit, self.weight(factor, key)) if adds is None else adds.when(hit, self.weight(factor, key))
            total = total + adds
        return total

    def posterior(self, names: list[str], votes: Votes) -> float:
        cast = dict(zip(names, votes))
        logit = math.log(self.prior / (1 - self.prior))
        logit += sum(self.weight(f, tuple(cast[n] for n in group)) for f, group in FACTORS.items())
        return 1 / (1 + math.exp(-logit))


def expectation_maximisation(patterns: list[tuple[Votes, int]], names: list[str], rounds: int = 100) -> LabelModel:
    """Fit the label model on counted vote patterns; rates start from, and lean on, the opinion."""
    keys = {
        f: sorted({tuple(votes[names.index(n)] for n in group) for votes, _ in patterns}, key=str)
        for f, group in FACTORS.items()
    }
    model = LabelModel(START_PRIOR, {})
    total = sum(count for _, count in patterns)
    for _ in range(rounds if total else 0):
        mass = [0.0, 0.0]  # of good, of bad
        cast = {f: {key: [0.0, 0.0] for key in found} for f, found in keys.items()}
        for votes, count in patterns:
            p = model.posterior(names, votes)
            for k, share in enumerate((p * count, (1 - p) * count)):
                mass[k] += share
                for f, group in FACTORS.items():
                    cast[f][tuple(votes[names.index(n)] for n in group)][k] += share
        rates = {
            f: {
                key: tuple(
                    (counts[k] + WEIGHT[k] * total * opinion(key, k)) / (mass[k] + WEIGHT[k] * total) for k in range(2)
                )
                for key, counts in found.items()
            }
            for f, found in cast.items()
        }
        prior = (mass[0] + PRIOR_WEIGHT * total * START_PRIOR) / (total * (1 + PRIOR_WEIGHT))
        model = LabelModel(prior, rates)
    return model


def fit(judged: DataFrame, signal: str) -> LabelModel:
    """Count vote patterns over all rows and estimate the rules' accuracies."""
    votes = rules(F.col(signal))
    names = list(votes)
    counted = (
        judged.select(*[v.cast("int").alias(k) for k, v in votes.items()])
        .groupBy(*names)
        .agg(F.count("*").alias("rows"))
        .collect()  # at most 4^7 rows
    )
    patterns = sorted(
        ((tuple(r[k] for k in names), r["rows"]) for r in counted),
        key=lambda x: tuple(-1 if v is None else v for v in x[0]),
    )
    return expectation_maximisation(patterns, names)


def with_signals(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    name = free_name(docs, "rule_signals")
    return once(docs, name, signals(F.col(text))), name


def _failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (
        100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"]
    )


def judge(docs: DataFrame, text: str = "text", model: LabelModel | None = None) -> DataFrame:
    """docs with the signals, base_failed, quality (posterior of good) and kept; no text.

    The texts are read once: rows and their signals are written without the text, then
    the model is fitted on them and applied to them.
    """
    judged, name = with_signals(docs, text)
    judged = settled(judged.drop(text))
    model = model or fit(judged, name)
    s = F.col(name)
    logit = model.logit(rules(s))
    added = {k: s[k] for k in SIGNALS} | {
        "base_failed": _failed(s),
        "quality": 1 / (1 + F.exp(-logit)),
        "kept": ~_failed(s) & (logit >= 0),
    }
    taken = {k.lower() for k in added} | {name.lower()}
    rest = [F.col(f"`{c}`") for c in judged.columns if c.lower() not in taken]
    return judged.select(*rest, *[v.alias(k) for k, v in added.items()])


def kept(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs that the rules keep, same columns.

    Rows with their signals are written once and read for the model and for the result, so
    every text is measured once.
    """
    judged, name = with_signals(docs, text)
    judged = written(judged, "rule-signals")
    model = fit(judged, name)
    s = F.col(name)
    stays = ~_failed(s) & (model.logit(rules(s)) >= 0)
    return judged.filter(stays).select(*[F.col(f"`{c}`") for c in docs.columns])
