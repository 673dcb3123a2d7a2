import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for their own columns.
        T.StructField("score", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("a.b", T.StringType()),
    ]
)

LONG = " ".join(f"word{i % 977} and{i}" for i in range(30_000))
TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs away from the farm",
    "The quick brown fox jumps over the lazy dog and runs away from the farm",
    "", None, "one", "one two", "  \t\n ", LONG, "日本語のテキスト 😀 ﬁ", "x" * 50_000,
    "mail bob.smith@example.com or +1 (017) 555-7713 from 10.0.0.1", "a\x00b \x01 c",
    "One\ntwo  three \n\n four ", "<|endoftext|> <s> </s> ▁▁ a", "1 " * 3000,
]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of texts; ids, sources and further columns can be null or repeat."""

    def make(texts, ids=None, sources=None):
        ids = ids or range(len(texts))
        sources = sources or [["b", None, "a", "é"][i % 4] for i in range(len(texts))]
        rows = [(i, t, None, s, None, "x", None, "y") for i, t, s in zip(ids, texts, sources)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Null, empty and very long texts, equal texts, a null id and a repeated row."""
    return docs_of([*TEXTS, "no id", "again", "again"], [*range(len(TEXTS)), None, 100, 100])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
