"""Small documents that hold what real ones do: NULLs, nothing, ties, repeats, length."""

import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame of documents with extra columns whose names operators use inside."""

    def make(rows, schema="doc_id long, text string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, schema)
        extra = [c for c in ("id", "n", "node", "key", "value", "lang", "digest") if c not in df.columns]
        return df.withColumns({c: F.lit(f"extra {c}") for c in extra}).repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    """Pseudo-random words with a few very common ones."""

    def make(n, seed, vocabulary=400):
        rng = random.Random(seed)
        own = [f"w{i}" for i in range(vocabulary)]
        return " ".join(rng.choice(own) if rng.random() < 0.7 else "the" for _ in range(n))

    return make
