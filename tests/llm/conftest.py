import random

import pytest

DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"
# columns that an operator could trip over
EXTRA = ["_id", "_mark", "_key", "node", "size", "label", "row", "places", "score", "h", "bands", "_copy"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts or (doc_id, text, lang, source); ``extra`` adds columns with clashing names."""

    def build(rows, extra=False):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            r = (*r, "en", "s1")[:4] if len(r) < 4 else r
            full.append((r[0], r[1], r[2], r[3], len(r[1]) if r[1] is not None else None))
        df = spark.createDataFrame(full, DOC_DDL).repartition(3)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumns({name: F.lit(f"x{name}") for name in EXTRA})
        return df

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, ties and repeated rows."""
    words = " ".join(random.Random(3).choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(i % 97) for i in range(30_000))
    return [
        (1, None, None, None), (2, "", "en", "s1"), (3, "  \n\t ", "de", "s2"), (4, "one", "en", "s1"),
        (5, "one", "en", "s1"), (5, "one", "en", "s1"), (None, "no id at all here", "fr", None),
        (None, "no id at all here", "fr", None), (None, "another without id", None, "s2"),
        (7, words, "en", "s1"), (8, words, "en", "s3"), (9, "x" * 50_000, "en", "s2"),
        (10, "two texts of one id", "en", "s1"), (10, "the other text of this id", "en", "s1"),
        (11, "ünï¢ødé ☃ 日本 ▁ 🎉", "ja", "s4"),
    ]


def invented(rnd, n, words=400):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def invent():
    return invented
