import pytest
from pyspark.sql import functions as F


@pytest.fixture
def docs(spark):
    """Nulls in every column, empty and blank and long texts, ties, repeated rows, an extra column."""
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog today", "en", "s0", 49, 1), (2, "the quick brown fox jumps over the lazy dog today", "en", "s0", 49, 2), (2, "the quick brown fox jumps over the lazy dog today", "en", "s0", 49, 2),
        (3, None, "en", None, None, 3), (4, "", None, "s1", 0, 4), (5, "  \n \n", "de", "s1", 5, 5), (None, "no id here at all but words", "fr", "s2", 27, None), (6, long, "en", "s2", len(long), 6),
        (7, "a@b.example.com wrote to +1 (578) 555-6437 about 4491382641088554", "en", "s3", 60, 7), (8, "ünïcode 日本 \U0001f600 text", "ja", "s3", 16, 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node long").withColumn("token", F.lit("x"))


@pytest.fixture
def empty(docs):
    return docs.limit(0)
