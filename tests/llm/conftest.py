from __future__ import annotations

import pytest
from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"

# documents with extra columns whose names clash with ones the operators use
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("rep", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("count", T.StringType()),
        T.StructField("rank", T.StringType()),
    ]
)
LABELS = "doc_id long, quality int, toxic int"
BENCHMARK = "item_id long, text string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """DataFrame of (doc_id, text) pairs with the clashing columns filled."""

    def make(pairs, langs=None):
        rows = [
            (d, t, (langs or {}).get(d, "en"), None if t is None else len(t), "x", "x", "x", "x", "x", "x")
            for d, t in pairs
        ]
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty, blank, long, tied and repeated rows."""
    long = " ".join(f"word{i % 977}x{i % 1009}" for i in range(30_000))
    plain = " ".join(f"plain{i}" for i in range(60))
    pairs = [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, plain), (6, plain), (7, plain + " tail"),
        (None, plain), (None, None), (8, "one"), (8, "one"), (9, "ünï çödé 日本 \U0001f600 ok"), (10, "a b c d e"),
    ]
    return make_docs(pairs)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    """(doc_id, text) rows of the smallest table."""
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
