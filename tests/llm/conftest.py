from __future__ import annotations

import random

import pytest
from pyspark.sql import Row

SYLLABLES = {
    "en": ["the", "ing", "and", "er", "tion", "wh", "st", "ould", "ly", "ness"],
    "fr": ["eau", "oui", "ez", "qu", "ment", "é", "ou", "aille", "eux", "ç"],
}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark):
    """240 labelled texts of two languages with copies, near copies, toxic words; then the odd rows."""
    rng = random.Random(3)
    rows = []
    for i in range(240):
        lang = "fr" if i % 3 == 0 else "en"
        text = "\n".join(sentence(rng, lang, rng.randint(8, 30)) for _ in range(rng.randint(1, 4)))
        if i % 8 == 1:
            text = text.replace(" ", " wretch", 1) + " wretch blockhead"
        rows.append([i, text, lang, f"s{i % 5}"])
    rows[11][1] = rows[10][1]
    rows[13][1] = rows[12][1] + " tail"
    return rows


ODD = [
    (1000, None, "en", "s1"),
    (1001, "", None, None),
    (1002, " \t\n", "en", "s2"),
    (1003, "!!! 123 ###", "en", "s0"),
    (None, "theing anding erly tionness whst ouldly", "en", None),
    (1004, "the and er " * 30000, "en", "s0"),
    (1005, "theing anding erly", "fr", "s3"),
    (1005, "theing anding erly", "fr", "s3"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that the operators use inside.
CLASHING = ["score", "spans", "leaks", "node", "n", "words", "text_key", "line_key", "size", "component", "row", "kind"]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """All rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([Row(*r) for r in [*map(tuple, corpus), *ODD]], SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
