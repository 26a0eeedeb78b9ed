from __future__ import annotations

import pytest

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{DIR}/labels.parquet")


def _odd(spark, rows):
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, n_words string, "
        "words string, spans string, uid string, id string, key string, rate string, posterior string",
    )


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, very long, repeated and tied rows, under column names that operators use themselves."""
    many = " ".join(f"word{i % 977}x{i % 131}" for i in range(60_000))
    texts = [None, "", " \n\t ", many, many, "one", "one", "two words", "A b c d e f g h i j k l", "ÄÖ ß 日本 \U0001f600 ok"]
    rows = [(i, t, None, "s", None, *["own"] * 10) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, "no id at all", *rows[0][2:]), (None, None, *rows[0][2:])]
    return _odd(spark, rows)


@pytest.fixture(scope="session")
def none(spark):
    return _odd(spark, [])
