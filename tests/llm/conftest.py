from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))  # one very long text, with some line ends
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names the operators use themselves
    T.StructField("id", T.StringType()), T.StructField("score", T.StringType()), T.StructField("_id", T.StringType()),
    T.StructField("_tie", T.StringType()), T.StructField("taken", T.StringType()), T.StructField("n_words", T.StringType()),
])
WORDS = [f"{a}{b}" for a in ("lo", "re", "mi", "sa", "tu", "ve") for b in ("n", "ck", "st", "ra", "del", "ting", "o", "bur")]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def messy_rows() -> list[tuple]:
    """NULLs in every column, empty and very long texts, ties, repeated rows, near copies."""
    rng = random.Random(5)
    base = sentence(rng, 120)
    near = base.replace(" ", "  ", 3).upper()
    edited = " ".join([*base.split()[:-1], "altered"])
    texts = [base, base, near, edited, None, "", " \t\n", "one two", LONG.replace("w5x5", "\n"), "é ö ß 漢字 \U0001f600 e", base,
             *[sentence(rng, rng.randint(3, 80)) for _ in range(30)]]
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, len(t) if t else None, *["x"] * 6) for i, t in enumerate(texts)]
    rows += [rows[0], rows[12], (None, texts[13], None, None, None, *[None] * 6), (None, None, None, None, None, *[None] * 6),
             (14, "another text under an id that is taken", "en", "s1", 0, *["x"] * 6)]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
