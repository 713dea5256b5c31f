"""Small tables with the cases that every operator has to take."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("shard", T.StringType()),
    ]
)
LONG = "word Ärger 12 " * 20_000


def documents(spark, texts, parts=3):
    """Documents from ``(doc_id, text)`` pairs, with a further column of a clashing name."""
    rows = [(i, t, None if i == 3 else "en", "s", None if t is None else len(t), "own") for i, t in texts]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(parts)


def odd(*more):
    """Null and empty texts, a very long one, repeated rows, a null id, and ``more``."""
    return [(1, None), (2, ""), (3, LONG), (4, " \n\t "), (5, "twice the same"), (5, "twice the same"), (6, "twice the same"), (None, "no id at all"), *more]


def key(row):
    return tuple((value is None, value) for value in row)
