import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from txnlab.llm.queries import ship

    ship(spark)


@pytest.fixture(scope="session")
def docs001(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def odd_rows():
    """Nulls in any column, empty and blank texts, ties, repeated rows, a long text."""
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    return [
        (1, base, "en", "a", 10), (1, base, "en", "a", 10), (2, base, "en", "a", 10), (3, None, "en", "a", None),
        (4, "", "en", "b", 0), (5, " \n\t ", None, "b", 3), (None, base + " x", "en", None, 5),
        (6, "word " * 30_000, "en", "a", 150_000), (7, "é ü ß 漢字 \U0001f600", "de", None, 9),
        (8, "a", "", "", 1), (None, None, None, None, None),
    ]
