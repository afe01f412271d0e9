import random

import pytest

from tidewatch.llm.textkit import package_on_workers

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    package_on_workers(spark)


def frame(spark, texts, schema=DOC):
    """Documents from texts (ids 0, 1, ..) or from (doc_id, text) pairs."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)


def clashing(df):
    """The frame with further columns named like things the operators use."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(1) for c in ("g", "left", "first", "seg", "anchor", "body", "n", "rank", "score", "rows", "held_out", "word", "p", "rate", "node", "kept", "label")})


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{int(vocabulary * r.random() ** 2)}" for _ in range(words))
