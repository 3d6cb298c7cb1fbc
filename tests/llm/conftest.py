import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fold string, rank int, `print` int"


def frame(spark, rows):
    """Documents from (doc_id, text), with columns named like working columns of operators."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", 7, 8) for i, t in rows], SCHEMA)


ODD = [
    (5, None),
    (3, ""),
    (None, "no id but text"),
    (7, "same words here"),
    (7, "same words here"),
    (9, "same words here"),
    (11, "long " * 30_000 + "end"),
    (12, "é ß 漢字 😀 İ"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def documents():
    return duckdb.connect().execute(
        f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id"
    ).fetchall()
