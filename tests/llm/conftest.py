import re

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, n long, body string, row int, cid long, pos int, n_lines long, score string, position double"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def documents(spark, rows):
    """``rows``: (doc_id, text[, source]); every other column clashes with a name the operators use."""
    data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), 7, "k", 7, "b", 7, 7, 7, 7, "s", 7.0) for r in rows]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def sf_docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
