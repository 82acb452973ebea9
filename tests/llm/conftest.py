import pytest
from pyspark.sql import types as T

from ..conftest import SF001, spark  # noqa: F401

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
)


@pytest.fixture(scope="session")
def make_docs(spark):  # noqa: F811
    """Documents from texts (ids from 0) or (id, text) pairs."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, None) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def corpus(spark):  # noqa: F811
    """(id, text, lang) of the smallest supplied table, and the table."""
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    return [(r.doc_id, r.text, r.lang) for r in df.collect()], df


#: Texts that every operator must take: null, empty, blank, tie, very long, odd characters.
EDGES = [None, "", " \n\t ", "a", "same text here now", "same  text\nhere now", "word " * 20_000, "é中🎉 \x00 \x1c <|endoftext|>", "?!... 123"]
