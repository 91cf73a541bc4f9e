from __future__ import annotations

import random

import pytest
from llm_brute import words


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls in every column, empty, blank and very long texts, repeats, near copies and shared passages."""
    rng = random.Random(5)
    long_ = words(rng, 30_000)
    base = words(rng, 200)
    parts = base.split(" ")
    near = [" ".join(parts[:i] + ["zz"] + parts[i + 1:]) for i in (3, 60, 120, 199)]
    passage = words(rng, 60)
    texts = [None, "", "   \n\t ", "one", "Two words", base, base, *near, near[0], long_, words(rng, 90) + " " + passage + " " + words(rng, 80),
             passage + " " + words(rng, 50), words(rng, 30) + "\n" + passage + " " + passage, " lead  and   trail  ", "é ñ ß <s> <|endoftext|> \x00x",
             "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a", "x" * 5000, "1.2.3.4 a@b.co +1 (555) 555-0100 4111 1111 1111 1111"]
    rows = [(i, t, ("en", "de", None)[i % 3], "src" if i % 2 else None, len(t) if t else None) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, "no id here at all", "en", "src", 17), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The same as a table with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(odd_rows, schema)
    for name in ("score", "block", "node", "shard", "n", "ids", "token", "size"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
