import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """DataFrame of documents from (doc_id, text, source) rows."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def prose(seed: int, n: int) -> str:
    """Invented words, the same for the same seed."""
    import random
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ru", "te", "sa"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
