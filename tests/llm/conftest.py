import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from setforge.session import local_session

    session = local_session("8", shuffle_partitions=4, name="tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the smallest documents table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


LONG = "word " * 3000
#: Nulls, empty and blank texts, repeated rows, ties, a very long text, and columns with clashing names.
ODD = [
    (1, "plain words of a short text that says enough to be kept by the rules of twenty words or more here now", "en", "a", 1, "x"),
    (1, "plain words of a short text that says enough to be kept by the rules of twenty words or more here now", "en", "a", 1, "x"),
    (2, None, "en", None, 0, None),
    (3, "", None, "a", 0, "x"),
    (4, " \t\n\x0b ", "en", "b", 5, "x"),
    (None, "a row without id", "en", "b", 16, "x"),
    (None, None, None, None, None, None),
    (5, LONG, "en", "b", len(LONG), "x"),
    (6, "é" * 20000 + " ßtraße\n" + "token = \"abcdef0123456789abcdef01\"", "de", "a", 3, "x"),
    (6, "another text of the same id", "de", "c", 3, "x"),
]
ODD_TYPE = "doc_id long, text string, lang string, source string, n_chars long, size string"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_TYPE).withColumnRenamed("size", "again")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD_TYPE)
