import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """A documents table from (doc_id, text[, source]) rows; further columns may be added."""

    def make(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(3)
        from pyspark.sql import functions as F

        for name in extra:
            df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.fixture
def prose():
    """Repeatable invented text of so many words."""

    def make(words, seed):
        draw = random.Random(seed)
        made = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6))) for _ in range(words)]
        return " ".join(made)

    return make


@pytest.fixture
def odd_rows(prose):
    """Null ids, texts and sources, empty and blank texts, a very long text, ties and repeated rows."""
    long = prose(60_000, 99)
    return [
        (1, prose(60, 1), "a"), (2, prose(60, 2), "b"), (3, None, "a"), (4, "", "b"), (5, " \n\t ", None),
        (6, prose(3, 6), None), (None, prose(60, 7), "a"), (None, None, None), (8, prose(60, 1), "a"),
        (9, long, "c"), (10, prose(60, 10), "a"), (10, prose(60, 10), "a"), (11, "é ß 漢字 \U0001F600 x", "b"),
    ]
