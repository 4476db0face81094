"""Awkward decision records shared by the tests of this folder."""

import pytest

LONG = "grave marker near the old chapel wall " * 3000


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns named like inner ones."""
    rows = [
        (1, "Burial ground found below the car park. Burial ground found below the car park.", "en", "a"),
        (2, "", "en", "a"),
        (3, None, None, None),
        (4, " \t\n ", "fr", "b"),
        (5, LONG, "en", "a"),
        (6, "Burial ground found below the car park. Burial ground found below the car park.", "en", "a"),
        (7, "été café 漢字 😀 naïve", "fr", "b"),
        (7, "été café 漢字 😀 naïve", "fr", "b"),
        (None, "no order given", "en", "c"),
        (None, None, "en", "c"),
    ]
    df = spark.createDataFrame(rows, "row_ord long, desc string, lang string, source string")
    clash = ["shard", "slot", "_hash", "pos", "word", "term", "size", "score", "n_words", "key", "text", "_nth"]
    for c in clash:
        df = df.selectExpr("*", f"'x' as {c}")
    return df
