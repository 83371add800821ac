import math

import public_tokenizers
import pytest
from pyspark.sql import types as T

#: Names that operators use themselves, as columns of the caller.
CLASHING = ("node", "bucket", "size", "Slot", "key", "gone", "copies", "text_mark", "n_lines", "slice", "row", "part", "a.b", "severity")


@pytest.fixture(scope="session")
def tokenizer_path():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source) rows, with columns that clash with names inside the operators."""

    def make(rows):
        fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
        schema = T.StructType(fields + [T.StructField(c, T.StringType()) for c in CLASHING])
        return spark.createDataFrame([(*r, *("x" for _ in CLASHING)) for r in rows], schema)

    return make


LONG = " ".join(f"w{k % 977}x{k}" for k in range(60_000))
COPY = " ".join(f"copied{k}" for k in range(80))

#: Nulls, empty, blank and very long texts, ties, repeated rows and ids, copies.
ODD_ROWS = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, LONG, "b"), (5, COPY, "a"), (6, COPY, "b"), (7, COPY + " tail", "é"),
    (None, COPY, "a"), (None, None, None), (8, "few words", "a"), (9, "Few  WORDS", "b"), (10, "one", "a"), (10, "one", "a"), (10, "another one", "a"),
    (11, "line one\nline two\nline three", "c"), (12, "other\nline two\nline three\n", "c"), (13, "line two\n\nline three\nline one", "d"),
]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs(ODD_ROWS)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int, node string, row string"
ODD_VECTORS = [
    (1, [1.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.0], 0), (3, [1.0, 0.01, 0.0], 0), (4, [1.0, 0.0, 0.0], 1), (5, [0.0, 0.0, 0.0], 0), (6, None, 0),
    (7, [], 0), (8, [1.0, None, 0.0], 0), (9, [math.nan, 1.0, 0.0], 0), (10, [math.inf, 1.0, 0.0], 0), (11, [1.0, 0.0, 0.0], None), (12, [1.0, 0.0, 0.0], 0),
    (12, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0, 0.0], 0), (None, [0.0, 1.0, 0.0], 3), (50, [0.5, 0.5, 0.5], 1), (100, [1.0, 0.0, 0.0], 2), (150, [-0.0, 1.0, 0.0], 2), (151, [0.0, 1.0, 0.0], 2),
]


@pytest.fixture(scope="session")
def odd_vectors(spark):
    return spark.createDataFrame([(*v, "x", "y") for v in ODD_VECTORS], VECTOR_SCHEMA)


@pytest.fixture(scope="session")
def no_vectors(spark):
    return spark.createDataFrame([], VECTOR_SCHEMA)
