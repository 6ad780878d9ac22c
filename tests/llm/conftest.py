import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LONG = "word " * 40_000 + "x" * 5_000 + " " + "y " * 300
# Null ids and texts, empty and blank texts, a very long one, repeated rows, ids that occur with several texts.
EDGES = [
    (1, "One two three four five six seven eight nine ten.", "en", "a"),
    (1, "One two three four five six seven eight nine ten.", "en", "a"),
    (2, "One two three four five six seven eight nine ten.", None, "a"),
    (2, "Another text altogether", "en", None),
    (3, "", "en", "a"),
    (4, None, "fr", "b"),
    (5, " \t\n ", "fr", "b"),
    (None, "A text without an id", "en", "a"),
    (None, None, None, None),
    (6, LONG, "en", "a"),
    (7, "a  b   c \n\n d<|endoftext|>e ▁ é 漢字 \U0001f600 #*$%&|<> ", "de", "c"),
    (8, "Zeile\nZeile\nZeile\n \n\nEnde", "de", "c"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Edge cases in a table that also has columns with names that the operators use inside."""
    from larder.llm.tables import ready

    ready(spark)
    clash = ["score", "fp", "rep", "digest", "n_tokens", "_row", "_d", "_lang", "length", "vector", "label", "kept", "component_id"]
    df = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("clash").alias(c) for c in clash])


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.filter("false")


def by_row(df, *columns):
    """Rows as sorted tuples, nulls first."""
    found = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda r: [(x is not None, x) for x in r])
