"""Shared by the tests of this folder."""
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = []
    for r in rows:
        r = tuple(r) + ("en", "src0")[len(r) - 2:]
        full.append(r + (None if r[1] is None else len(r[1]),))
    return spark.createDataFrame(full, DOC_SCHEMA)


def write_docs(spark, rows, path):
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    return str(path)
