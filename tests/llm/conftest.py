"""Small tables for the operators' tests."""

import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def make_documents(spark, texts, extra=None):
    """Documents 0, 1, ... of ``texts``; ``extra`` gives columns beside them, by name."""
    rows = [
        (k, t, ("en", "fr", "de", None)[k % 4], f"src{k % 3}", None if t is None else len(t))
        for k, t in enumerate(texts)
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(v) for n, v in (extra or {}).items()})


@pytest.fixture
def documents(spark):
    return lambda texts, extra=None: make_documents(spark, texts, extra)


@pytest.fixture
def words():
    """``words(seed, n)``: n invented words."""

    def make(seed, n):
        r = random.Random(seed)
        return [
            "".join(r.choice(["ka", "lo", "mi", "ren", "ta", "vos"]) for _ in range(3)) for _ in range(n)
        ]

    return make
