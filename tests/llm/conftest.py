import os
import random
import sys

import public_tokenizers
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402

cloudpickle.register_pickle_by_value(corpus_pipeline)

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text, lang, source) as a table with columns whose names clash with inner ones."""

    def make(rows):
        full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        for clash in ("row", "key", "node", "kept", "hash", "signature", "size", "rank"):
            df = df.withColumn(clash, F.lit(clash))
        return df

    return make


@pytest.fixture(scope="session")
def words():
    """A function from a seed and a number to a text of so many invented words."""

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(
            "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)
        )

    return make


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path
