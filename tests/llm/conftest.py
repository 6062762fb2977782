import pytest
from pyspark.sql import types as T

from cleartab.session import Staging

# Two documents per odd case, and a column whose name the operators use themselves.
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("size", T.StringType()), T.StructField("node", T.StringType())])


@pytest.fixture
def make(spark):
    """A documents table from (doc_id, text[, lang, source]) rows, with clashing extra columns."""
    def rows(*items):
        full = [(i, t, *(rest + ["en", "a"][len(rest):]), None if t is None else len(t), "x", "y")
                for i, t, *rest in items]
        return spark.createDataFrame(full, DOCUMENTS)
    return rows


@pytest.fixture
def staging(spark):
    with Staging(spark) as area:
        yield area


PROSE = " ".join(f"word{i % 37}{'abcdefg'[i % 7]} and{i}" for i in range(200))


@pytest.fixture
def odd(make):
    """Nulls, empty texts, ties, repeated rows, one very long text."""
    return make((1, PROSE), (2, None), (3, ""), (4, PROSE), (4, PROSE), (5, "  \n\t "), (6, "short one", None, None),
                (7, PROSE.replace("and5 ", "or5 ")), (None, "a text without id", None, "b"), (8, "lang " * 60_000),
                (9, "Größe naïve 東京 🙂 " * 30, "de", "ß"), (10, "A line that is long enough\n" * 5))
