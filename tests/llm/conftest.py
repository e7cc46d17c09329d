import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox jumps over the lazy dog and runs far away"


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, empty and long texts, ties and repeats."""
    near = [f"{LONG} number {i} of a long line of words that hardly differ at all" for i in range(4)]
    rows = [(i, f"{LONG}\nline {i}\n  {LONG.upper()} ") for i in range(6)]
    rows += [(10, ""), (11, None), (12, " \n\t "), (13, "a"), (14, "a b"), (15, "A  B"), (16, "ab"), (17, "x" * 30_000)]
    rows += [(20, "word " * 9_000), (21, "é à ü " * 50 + "　▁ " + LONG), (None, LONG), (None, "lost words here")]
    rows += [(30 + i, t) for i, t in enumerate(near)] + [(40, LONG), (41, LONG), (41, LONG), (42, LONG), (42, "second text")]
    return rows


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table with the given (doc_id, text) and columns whose names clash with the operators' own."""

    def make(rows):
        wide = [(d, t, "en", "s", 0, 1, "k", 2) for d, t in rows]
        schema = f"{DOCS}, hash long, text_key string, row long"
        return spark.createDataFrame(wide, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def plain_rows(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from jobtide.llm.common import ship

    ship(spark)
