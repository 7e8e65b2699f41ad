from __future__ import annotations

import pytest

from riskloom.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")


@pytest.fixture(scope="session")
def rows_of():
    """Rows of a data frame as a sorted list of tuples."""
    return lambda df, *columns: sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture(scope="session")
def result(spark):
    """The whole result of a registered query over the smallest tables, computed once."""
    seen = {}

    def get(name):
        if name not in seen:
            seen[name] = queries.QUERIES[name](spark, SMALL).toPandas()
        return seen[name]

    return get


# Texts that try the edges: null, empty, blank, very long, odd letters, repeats; other columns clash with working names.
TEXTS = [
    None,
    "",
    "  \n\t ",
    "a",
    "the same line of seven words here\nthe same line of seven words here",
    "word " * 30_000,
    "x" * 100_000,
    "  lead and   trail  don't we'll 12 345 \U0001f600 café ΣΣ İ </turn> <|endoftext|>\n\n\nend ",
    "the same line of seven words here",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, i, "a", 1, "b", "c", 0, 2) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here", *[None] * 7), *[(3, "a", 3, "a", 1, "b", "c", 0, 2)] * 2]
    return spark.createDataFrame(
        rows, "doc_id long, text string, n_chars long, label string, h1 int, ids string, _id string, _drops int, uid int"
    )
