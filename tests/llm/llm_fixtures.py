"""Fixtures of the operator tests: a documents table and its odd rows."""

import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents-shaped frame from (doc_id, text[, lang, source]) rows."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0",
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOC).repartition(parts)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, short, long, repeated and tied texts."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["été", "größe", "x", "#tag", "a|b"]
    base = [" ".join(rng.choices(words, k=rng.randint(60, 200))) for _ in range(12)]
    long = " ".join(rng.choices(words, k=30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, "a b c d"), (7, "a b c d e"),
            (8, base[0]), (9, base[0]), (10, base[0].upper()), (11, base[1] + " tail one two"), (12, base[1]),
            (13, base[2] + "\n" + base[2]), (14, long), (15, long + " more"), (16, "x" * 70_000),
            (17, base[3].replace(" ", "\n", 9)), (18, base[4] + " " + base[5]), (19, base[6] + " " + base[5]),
            (20, "word " * 400), (21, " wide space words\x0bhere\x0cnow"), (8, base[0]), (22, base[7][:-3])]
    return rows


@pytest.fixture(scope="session")
def extra_columns(docs_of, odd_rows):
    """The odd rows with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    d = docs_of(odd_rows)
    for c in ("n_words", "kept", "row", "id", "size", "token", "comp", "score", "ids", "part", "h", "bits", "slot", "doc", "th",
              "row_id", "src", "taken", "n", "label", "at"):
        d = d.withColumn(c, F.lit("clash"))
    return d
