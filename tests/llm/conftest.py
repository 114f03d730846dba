import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def make_docs(spark, rows, extra=()):
    """Documents from (doc_id, text) or (doc_id, text, lang); ``extra`` names clashing columns, filled with -1."""
    data = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(data, DOCS).repartition(3)
    from pyspark.sql import functions as F
    for name in extra:
        df = df.withColumn(name, F.lit(-1))
    return df


def awkward_rows():
    """Nulls, empty and long texts, ties, repeated rows, odd characters."""
    rng = random.Random(5)
    words = ["the", "and", "Straße", "été", "niño", "alpha", "beta", "gamma", "delta", "42", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    long = " ".join(rng.choice(words) + str(i % 977) for i in range(60_000))
    rows += [(100, None), (101, ""), (102, ""), (103, "   \n\t "), (104, "ÀÉ"), (105, "àé"), (106, "ABC def"),
             (107, "abc DEF"), (108, "abc def"), (108, "abc def"), (108, "abc def"), (None, "abc def"), (None, None),
             (109, long), (110, long.upper()), (111, long), (112, "\x00\x1f a\x0bb"), (113, "😀 word 😀")]
    rows += [(200 + i, "one hot text " * 5) for i in range(60)]
    rows += [(300, "one hot text " * 5)] * 30
    return rows


@pytest.fixture(scope="session")
def awkward():
    return awkward_rows()
