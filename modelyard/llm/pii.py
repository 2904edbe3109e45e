"""Personal data in texts, in DataFrame operations only.

Regular expressions propose spans, validators (part range, Luhn, digit counts, mod-97)
confirm them, and words near a span raise or lower its score. The four base kinds stay
whenever they are valid; the added kinds (iban, national_id) must reach MIN_SCORE.

Defined results: a null text counts as empty and has no spans. Each row is judged by its
own text, so copies agree; empty tables give empty tables; extra columns pass through and
a column of the result's name is replaced. Possessive patterns keep very long texts linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.llm.text import let, once

KINDS = ("email", "ip", "card", "phone", "iban", "national_id")
BASE_KINDS = KINDS[:4]
MIN_SCORE = 0.6
NEAR = 40  # characters of context on either side

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    # a run of local characters is tried once, from its start or from the last match's end
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Cheap tests that a text can hold the kind at all.
POSSIBLE = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda t: t.rlike(r"\+[0-9]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
    "national_id": lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
}
CONTEXT = {
    "email": "e-?mail|contact|write to|courriel|correo",
    "ip": "address|server|host|ip",
    "card": "card|visa|master|credit|debit|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "national_id": "ssn|social security|national id|insurance",
}
AGAINST = "order|invoice|isbn|serial|version|part no"
START_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.8, "iban": 0.8, "national_id": 0.4}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """The Luhn checksum of a string of digits holds."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(
        values,
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d),
    )
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def mod97(iban: Column) -> Column:
    """The ISO 7064 mod-97 checksum of an account number without spaces holds."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    codes = F.transform(F.split(moved, ""), lambda c: F.ascii(c))
    rest = F.aggregate(
        codes,
        F.lit(0),
        lambda acc, c: F.when(c >= 65, (acc * 100 + c - 55) % 97).otherwise((acc * 10 + c - 48) % 97),
    )
    return rest == 1


def valid(kind: str, value: Column) -> Column:
    """The validator of a kind; null counts as failed."""
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        checked = F.forall(
            parts, lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255"))
        )
    elif kind == "card":
        checked = let(
            _digits(value),
            lambda d: F.when(F.char_length(d).between(13, 19), luhn(d)).otherwise(False),
        )
    elif kind == "phone":
        checked = F.char_length(_digits(value)).between(9, 15)
    elif kind == "iban":
        checked = let(
            F.replace(value, F.lit(" "), F.lit("")),
            lambda v: F.when(F.char_length(v).between(15, 34), mod97(v)).otherwise(False),
        )
    elif kind == "national_id":
        checked = ~value.rlike("^(000|666|9)|-00-|-0000$")
    else:
        checked = F.lit(True)
    return F.coalesce(checked, F.lit(False))


_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"


def _proposed(kind: str, text: Column) -> Column:
    """All matches with their places: the pieces between matches give the starts."""
    pieces = F.split(text, PATTERNS[kind])
    matches = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))

    def place(m: Column, p: Column) -> Column:
        lengths = F.transform(
            m, lambda x, i: F.struct(F.char_length(F.get(p, i)).alias("gap"), x.alias("value"))
        )
        start = F.struct(
            F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found")
        )

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            end = begin + F.char_length(x["value"])
            span = F.struct(
                F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["value"].alias("value")
            )
            found = F.when(valid(kind, x["value"]), F.concat(acc["found"], F.array(span)))
            return F.struct(end.alias("at"), F.coalesce(found, acc["found"]).alias("found"))

        return F.aggregate(lengths, start, step, lambda acc: acc["found"])

    return let(matches, lambda m: let(pieces, lambda p: place(m, p)))


def _scored(text: Column, span: Column) -> Column:
    kind = span["kind"]
    begin = F.greatest(span["start"] - NEAR, F.lit(0))
    around = F.lower(
        F.concat_ws(
            " ",
            F.substr(text, (begin + 1).cast("int"), (span["start"] - begin).cast("int")),
            F.substr(text, (span["end"] + 1).cast("int"), F.lit(NEAR)),
        )
    )

    def by_kind(values: dict) -> Column:
        out = F.lit(None)
        for k in KINDS:
            out = F.coalesce(out, F.when(kind == k, values[k]))
        return out

    score = (
        by_kind({k: F.lit(v) for k, v in START_SCORE.items()})
        + by_kind({k: F.when(around.rlike(rf"\b(?:{w})\b"), 0.3).otherwise(0.0) for k, w in CONTEXT.items()})
        - F.when(around.rlike(rf"\b(?:{AGAINST})\b"), 0.15).otherwise(0.0)
    )
    return F.struct(
        kind.alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        span["value"].alias("value"),
        F.round(F.least(score, F.lit(1.0)), 2).alias("score"),
    )


def spans(text: Column) -> Column:
    """Confirmed spans (kind, start, end, value, score) by kind, then start; code points."""

    def of(t: Column) -> Column:
        none = F.array().cast(f"array<{_SPAN}>")
        found = F.concat(
            *[F.when(POSSIBLE[k](t), _proposed(k, t)).otherwise(none) for k in KINDS]
        )
        return F.filter(
            F.transform(found, lambda s: _scored(t, s)),
            lambda s: s["kind"].isin(*BASE_KINDS) | (s["score"] >= MIN_SCORE),
        )

    return let(F.coalesce(text, F.lit("")), of)


def masked(text: Column, found: Column) -> Column:
    """text with every span replaced by its kind in brackets; overlapping spans merge.

    A merged stretch carries the kind of its first span. Null stays null.
    """
    ordered = F.array_sort(
        F.transform(
            found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when(
            s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        ).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    built = F.aggregate(
        ordered,
        start,
        step,
        lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))),
    )
    return F.when(text.isNull() | (F.size(found) == 0), text).otherwise(built)


def find(docs: DataFrame, text: str = "text", result: str = "pii_spans") -> DataFrame:
    """docs with an array of confirmed spans."""
    rest = docs.drop(*[c for c in docs.columns if c.lower() == result.lower() and c != text])
    return once(rest, result, spans(F.col(text)))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with personal data in the text column masked; same columns."""
    from modelyard.llm.text import free_name

    name = free_name(docs, "pii_spans")
    found = find(docs, text, name)
    return found.withColumn(text, masked(F.col(text), F.col(name))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
