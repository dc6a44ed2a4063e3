import random

import pytest

SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi xo zu".split()


def prose(seed, words):
    """Invented text with many different words; the same for the same seed."""
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(SYLLABLES, k=draw.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty, blank and very long texts, repeated rows, and extra columns with clashing names."""
    long_text = prose(1, 60_000)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "One"), (4, "One"), (5, "one"), (None, "One"), (None, None),
        (6, long_text), (7, long_text + " end"), (8, "日本 é\x00\x1c ß 𝒳"), (9, "x " * 200), (10, "a" * 50_000), (None, prose(2, 50)),
    ]
    extra = ["id", "ids", "n", "name", "node", "keys", "first", "text_key", "score", "lang", "v", "size", "window"]
    values = [(*row, *[f"{c}{i}" for c in extra]) for i, row in enumerate(rows)]
    return spark.createDataFrame(values, "doc_id long, text string, " + ", ".join(f"{c} string" for c in extra)).repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
