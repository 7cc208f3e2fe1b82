import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), or none, with columns whose names clash with those of results."""
    def make(rows, clash=False):
        df = spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOCS)
        if clash:
            from pyspark.sql import functions as F
            for name in ("score", "kept", "n_tokens", "size", "key", "epoch", "digest", "rank", "n", "component", "rep", "part"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make


HARD = [(1, ""), (2, None), (None, "a b"), (None, None), (3, " \n\t"), (4, "x" * 70_000), (5, "word " * 30_000), (6, "dup text here"),
        (6, "dup text here"), (7, "dup text  here"), (8, "日本語 テキスト ñ É"), (9, "a\x00b\x85c d"), (10, "mit license")]


@pytest.fixture(scope="session")
def hard_rows():
    return HARD
