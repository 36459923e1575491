import os

import duckdb
import pytest

DATA = os.environ.get("PLAZA_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def small() -> str:
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def medium() -> str:
    return f"{DATA}/sf0.01"


@pytest.fixture(scope="session")
def table():
    """Rows of a table as dicts."""

    def read(folder: str, name: str) -> list[dict]:
        rel = duckdb.connect().execute(f"select * from '{folder}/{name}.parquet'")
        names = [d[0] for d in rel.description]
        return [dict(zip(names, r)) for r in rel.fetchall()]

    return read


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, repeated rows, ties, and an extra column with a clashing name."""
    text = "the quick brown fox jumps over the lazy dog near the river bank today"
    rows = [
        (1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text, "en", None, 2), (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \n\t ", "fr", "b", 3),
        (6, "x " * 60_000 + "end", "en", "c", 4), (7, "!!! ??? 123", "en", "c", 5), (8, "y" * 100_000, "de", "c", 6), (None, text, "en", "d", 7), (None, "other", "fr", "d", 7),
        (9, "Grüße, Étranger 日本語   x y", "de", "a", 8), (10, "a@b.co 1.2.3.4 +12 345 678 901 4111-1111-1111-1111", "en", "a", 9),
    ]
    rows = [(*r, "clash", "clash") for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string, score string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
