from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from jobmetrics.llm.common import prepared as prepare_session

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    # Names that operators use themselves.
    T.StructField("score", T.StringType()), T.StructField("bucket", T.IntegerType()),
    T.StructField("mixture", T.StringType()), T.StructField("n_chars", T.StringType()),
    T.StructField("component_id", T.StringType()), T.StructField("range", T.StringType()),
])
BIG = (1 << 62) + 1


def words(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(n))


EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, words(30_000, 5)), (5, words(30_000, 5)), (6, "one"),
    (None, "no id"), (None, None), (7, "!!! ### 123"), (8, "漢字 かな 😀😀   Ünïcödé"), (9, words(40, 9)),
    (BIG, words(40, 9) + " more"), (10, "x" * 20_000), (11, "A\r\nB\x0bC"),
]


@pytest.fixture(scope="session")
def prepared(spark):
    return prepare_session(spark)


def documents(spark, rows):
    return spark.createDataFrame([(*(r if len(r) == 3 else (*r, "en")), "s", 1, "m", "n", "c", "r") for r in rows], DOCUMENTS)


@pytest.fixture(scope="session")
def edges(prepared):
    return documents(prepared, EDGES)


@pytest.fixture(scope="session")
def nothing(prepared):
    return documents(prepared, [])
