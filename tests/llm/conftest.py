import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("digest", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("node", T.StringType()),
])

PROSE = " ".join(f"word{i * 7 % 61} and{i}" for i in range(60))


@pytest.fixture(scope="session")
def docs(spark):
    """(doc_id, text) rows as documents with further, clashing columns."""

    def make(*rows):
        full = [(i, t, "en", f"s{(i or 0) % 2}", len(t or ""), "x", "y", "z") for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls, empty and white texts, ties, repeated rows, other scripts, a long text."""
    return docs(
        (1, None), (2, ""), (3, " \n\t "), (None, PROSE), (None, None), (4, PROSE), (5, PROSE), (5, PROSE),
        (6, PROSE + " tail"), (7, "é🙂  x y  z\r\n<|endoftext|> <|endoftext|>\n\n"), (8, "a b c"),
        (9, "a  b\nc"), (10, "long " * 60_000), (11, "é" * 300), (12, "x" + "é" * 300),
    )
