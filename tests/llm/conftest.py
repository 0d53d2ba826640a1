import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977} the" for i in range(30_000))
PASSAGE = " ".join(f"pass{i}" for i in range(120))
BASE = "the quick brown fox jumps over the lazy dog and runs into the deep dark wood " * 3
#: Nulls, empty and blank texts, a very long one, ties, repeated rows, repeated ids, shared passages.
ODD = [
    (1, BASE, "b"), (2, BASE, "b"), (2, BASE, "b"), (3, BASE + "x", "a"), (4, None, "a"), (5, "", None),
    (6, " \t\n ", None), (7, LONG, "a"), (None, "no id at all " + PASSAGE, "c"), (None, None, None),
    (8, "start " + PASSAGE + " end", "c"), (9, PASSAGE, "c"), (9, "other text of nine", "c"), (10, "café 漢字 x", "é"),
    (11, "the the the the of of", "b"), (12, "x", "b"),
]
#: Further columns with names that the operators use inside.
CLASH = "key h sh fp row page host lines copy mark turn score size text_hash component lang".split()


@pytest.fixture(scope="session")
def odd(spark):
    kind = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in CLASH] + [T.StructField("n_chars", T.LongType())]
    )
    rows = [(*r, *[f"{c}{r[0]}" for c in CLASH], None if r[1] is None else len(r[1])) for r in ODD]
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
