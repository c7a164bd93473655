import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def stored(spark, tmp_path):
    """Writes rows as a Parquet table of two files and reads it."""
    count = iter(range(10**6))

    def write(rows, schema):
        path = str(tmp_path / f"table-{next(count)}")
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(path)
        return spark.read.parquet(path)

    return write


@pytest.fixture
def docs(stored):
    """A documents table from (doc_id, text) or longer rows."""

    def make(rows):
        full = [(*r, *("en", "src0")[len(r) - 2 :], None if r[1] is None else len(r[1])) for r in rows]
        return stored(full, DOCUMENTS)

    return make


@pytest.fixture
def odd_docs(docs):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long_text = "\n".join(f"long{k} text of many words number {k} goes on and on." for k in range(4000))
    rows = [
        (None, None, None, None),
        (None, "no id here but some words", None, None),
        (1, None, "en", None),
        (2, "", "en", "a"),
        (3, " \n\t ", None, "a"),
        (4, long_text, "en", "a"),
        (5, "same text twice in rows", "en", "b"),
        (5, "same text twice in rows", "en", "b"),
        (6, "same text twice in rows", "en", "b"),
        (7, "x", "en", "b"),
    ]
    return docs(rows)
