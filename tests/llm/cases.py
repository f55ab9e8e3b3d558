"""Rows that every operator has to take: nulls, empties, ties, repeats, long texts, clashing columns."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

LONG = " ".join(f"word{i % 997} tail{i}" for i in range(20_000))

ODD = [
    (1, "the quick brown fox jumps over the lazy dog and runs far away from here today", "en", "a", 77),
    (2, "the quick brown fox jumps over the lazy dog and runs far away from here today", "en", "a", 77),
    (2, "the quick brown fox jumps over the lazy dog and runs far away from here today", "en", "a", 77),
    (3, " the  quick brown fox jumps over the lazy dog and runs far away from here today\n", "en", None, None),
    (4, None, "en", "a", 0),
    (5, "", None, "b", 0),
    (6, " \t\n ", "de", None, 3),
    (None, "eine kleine nacht und noch ein satz mit worten ohne ende und sinn", None, None, None),
    (7, "12345 !!! ### $$$", "de", "b", 17),
    (8, LONG, "en", "a", len(LONG)),
    (9, "日本語テキスト 🎉 ▁under▁ <|endoftext|> 'll", "de", "c", 30),
]


def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return (text or "").encode().split()
