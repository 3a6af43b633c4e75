import json

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents of (doc_id, text) pairs."""

    def make(rows):
        made = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(made, DOCS)

    return make


#: Names that operators use themselves.
CLASHING = (
    "fp", "text_key", "root", "own_id", "own_key", "word", "n", "row", "bucket", "end",
    "sketch", "toxicity", "label", "pii", "leaks", "piece", "rank", "block", "_slice",
    "licenses", "host", "path", "rule", "verdict", "difference", "chance",
)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, ties and repeated rows, clashing names."""
    long = " ".join(f"word{i % 977} tail{i % 31}." for i in range(60_000))
    rows = [
        (1, "one two three four five six seven"),
        (1, "one two three four five six seven"),
        (1, "another text under the same id, contact a.b@example.com now"),
        (2, ""),
        (3, None),
        (None, "a row without an id"),
        (None, None),
        (4, " \n\t "),
        (5, long),
        (6, "naïve Ünïcode 日本語 \U0001f600 x"),
        (7, "one two three four five six seven"),
    ]
    made = [(i, t, None, None, None) for i, t in rows]
    docs = spark.createDataFrame(made, DOCS)
    return docs.withColumns({name: F.lit("x") for name in CLASHING})


@pytest.fixture(scope="session")
def rows_of():
    """Rows as a sorted list, so that order makes no difference."""

    def rows(df):
        return sorted((r.asDict(recursive=True) for r in df.collect()), key=json.dumps)

    return rows
