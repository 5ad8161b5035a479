import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs_of(spark):
    """Rows (doc_id, text) as a documents table."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    return make


def sentence(rng, n, words=4000):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))
