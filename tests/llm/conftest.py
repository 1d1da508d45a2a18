from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """doc_id to text of the small table."""
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with extra columns that clash with inner names."""

    def build(rows):
        rows = [(i, t, "en", "s", None) for i, t in rows]
        frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
            "*", "'x' AS shard", "1 AS print", "2 AS digest", "3 AS n_words", "4 AS path"
        )
        return frame

    return build


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    return make(
        [
            (1, None),
            (2, ""),
            (3, "   \t\n"),
            (None, "a text without an id that has some words in it"),
            (None, None),
            (4, "a b"),
            (4, "a b"),
            (4, "another text of the same id"),
            (5, "a \t\n b"),
            (6, long),
            (7, long),
            (8, "word " * 60),
            (9, "Ünïcödé ÀÉ   text \U0001f600"),
        ]
    )
