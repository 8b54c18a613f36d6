"""Fixtures of these tests; not a conftest, whose name the other tests import."""

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def sf():
    return SF_DIR


ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "One"),
    (6, "ein zwei drei vier fünf sechs sieben acht"),
    (6, "ein zwei drei vier fünf sechs sieben acht"),
    (None, "ein zwei drei vier fünf sechs sieben acht"),
    (7, "a\nb\n\na\nb\n"),
    (8, "12 34 -- !!"),
    (9, "lang " * 20_000),
    (10, "<|endoftext|> x'll don't Σας ΟΔΟΣ e\u0301 \u00a0 \ud7ff it's"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, a long one, repeated rows, a null id, and columns named like results."""
    df = spark.createDataFrame(ODD_TEXTS, "doc_id long, text string")
    extra = {"lang": "en", "source": "s", "score": "x", "kept": "x", "hits": "x", "row": "x", "n_lines": "x", "n": "x"}
    return df.select("*", *[F.lit(v).alias(k) for k, v in extra.items()])


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
