"""Fixtures of these tests (imported by name: a second conftest module would
hide the first)."""

import pytest

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """Workers import the package from what the session sends them."""
    from bucketlens.session import ship_package

    ship_package(spark)


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and blank texts, ties, repeated rows, columns that clash."""
    rows = [
        (1, None, 7, "x"),
        (2, "", 7, None),
        (3, " \n\t\n", None, "x"),
        (4, "one", 1, "x"),
        (4, "one", 1, "x"),
        (None, "a few plain words of text\nand another line", 2, "y"),
        (None, "a few plain words of text\nand another line", 2, "y"),
        (5, "x" * 50_000 + " " + "word " * 30_000, 2, "y"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, _row long, rank string")
