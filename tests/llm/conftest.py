from __future__ import annotations

import random

import pytest

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, found string, row string, part int, n int, kept boolean"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, near copies and shared passages."""
    draw = random.Random(5)
    words = [f"w{draw.randrange(400)}" for _ in range(4000)]
    base = " ".join(words[:120])
    near = " ".join([*words[:60], "other", *words[61:120]])
    passage = " ".join(words[200:230])
    texts = [
        base, base, near, f"{passage} {words[5]}", f"start {passage} end.", "", None, " \t\n", "one", "One", "two words", "é" * 70,
        "a" * 300, "a" * 299 + "b", " ".join(words * 5), f"é{passage}é", "123 456 !!", "#" * 60, "line one here\nline one here\nx",
    ]
    rows = [(n, t, ("en", None, "de")[n % 3], "s", 1, 7, "k", "f", "r", 1, 2, True) for n, t in enumerate(texts)]
    blank = (None,) * 12
    return [*rows, rows[0], rows[5], blank, blank, (None, base, *rows[0][2:]), (40, near, *blank[2:])]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, CLASHING).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], CLASHING)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").persist()
