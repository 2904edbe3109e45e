import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(["th", "er", "on", "ti", "ea", "in"]) for _ in range(r.randint(1, 4))) for _ in range(n)]


def edge_texts() -> list[str | None]:
    """Null, empty, blank, one word, ties, repeats, odd characters, a very long text."""
    base = " ".join(words(1, 60))
    return [
        None,
        "",
        " \t\n ",
        "x",
        "a b c d",
        base,
        base,
        base + " tail",
        "\n".join([base] * 3),
        "line one here\nline one here\n\n  \nline two",
        " ".join(["same"] * 200),
        "ünï ▁mark  two  spaces \U0001f642\x00\x1f end\u00a0nbsp",
        " ".join(words(2, 20_000)),
        "9" * 5000 + "." * 50 + "1 " * 3000,
        "a." * 4000 + "@" + "b." * 4000,
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(edge_texts())]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
