import os
import random

import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session", autouse=True)
def _package(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.dirname(__file__))))


#: a table with clashing further columns
SCHEMA = T.StructType([
    T.StructField("n_words", T.StringType()), T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("block", T.StringType()), T.StructField("n", T.StringType()),
])


def frame(spark, rows):
    return spark.createDataFrame([("x", i, t, None, "b", "n") for i, t in rows], SCHEMA)


def _text(rng, n, vocabulary=400):
    return " ".join(rng.choices([f"w{k}" for k in range(vocabulary)], k=n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, short and very long texts, ties, copies and near copies."""
    rng = random.Random(3)
    base, passage, long = _text(rng, 120), _text(rng, 30), _text(rng, 40_000, 5_000)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, None), (2, ""), (3, " \t\n\v\f\r "), (4, "one"), (5, "One two three"), (6, "one two three"),
        (7, base), (8, base), (9, base.upper()), (10, " ".join(near)), (11, f"{_text(rng, 50)}\n{passage}\n{_text(rng, 20)}"),
        (12, f"{passage} {_text(rng, 90)} {passage}"), (13, "a " * 500), (14, "a " * 501), (15, long), (16, long + " end"),
        (17, "é" * 5_000), (18, "zero width​ \x1c\x85 marks 漢字 😀 text"), (100, "a b c d e f g h i j k l m n o p"),
    ]
    return rows + [(200 + k, _text(rng, rng.randint(1, 60))) for k in range(30)]
