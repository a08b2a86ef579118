import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = ("the cat sat on a mat and " * 9000) + "mail me at long.text@mail.example.com now"

#: Nulls in every column, empty and very long texts, repeated rows.
ODD = [
    (1, "The cat sat on the mat.", "en", "a", 23),
    (1, "The cat sat on the mat.", "en", "a", 23),
    (2, None, "en", "a", 0),
    (3, "", "en", None, 0),
    (4, "   \n\t ", None, None, 6),
    (None, "A text without an id, sent by bob@mail.example.com.", None, "b", 51),
    (5, "12345 !!! ...", "en", "b", 13),
    (6, LONG, "en", "a", len(LONG)),
    (7, "naïve café 😀 déjà-vu", "fr", "c", 20),
    (8, "naïve café 😀 déjà-vu", "fr", "c", 20),
]


@pytest.fixture(scope="session")
def odd(spark):
    """A small documents table with every awkward case, and clashing extra columns."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ODD, SCHEMA)
    return docs.withColumns(
        {c: F.lit("x") for c in ("key", "size", "score", "fp", "kind", "path", "g", "n", "of", "z", "block", "best", "spans", "root")}
    )


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(corpus):
    return {r["doc_id"]: r["text"] for r in corpus.select("doc_id", "text").collect()}


@pytest.fixture()
def at(tmp_path, spark):
    """Stores a table as a data folder has it and returns the folder."""

    def store(df, name="documents"):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return store
