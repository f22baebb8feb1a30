"""Small odd inputs that every operator of documents has to take."""

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                         T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def words(n, seed=0):
    """n words that differ from those of other seeds."""
    return " ".join(f"w{(i * 7919 + seed * 104729) % 100003}x{seed}" for i in range(n))


ODD = [
    (1, words(60, 1), "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n\r\x0b\x0c ", "en", "b", 7),
    (5, "one two", "de", "b", 7),
    (6, words(60, 1), "en", None, 1),                     # a copy
    (7, "É ü 漢字 \U0001f600 naïve word   x", "fr", "c", 5),
    (8, words(60, 1) + " tail", "en", "c", 1),            # a near copy
    (9, "z" * 70_000 + " " + words(40, 2), "xx", "a", 1),  # one very long word
    (None, words(30, 3), "en", "a", 1),
    (10, words(30, 4), "en", "a", 1),
    (10, words(30, 4), "en", "a", 1),                     # the same row again
    (10, words(30, 5), "en", "a", 1),                     # the same doc_id, another text
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENT)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def clashing(spark):
    """Extra columns named like results and like internal columns."""
    from pyspark.sql import functions as F

    extra = ["n_words", "kept", "size", "shard", "slot", "spans", "version", "c", "label", "id", "row", "n_tokens", "licence", "block", "copy", "ids"]
    return spark.createDataFrame([r for r in ODD if r[0] is not None][:6], DOCUMENT).select("*", *[F.lit("x").alias(c) for c in extra])
