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

LONG = " ".join(f"word{i % 977} filler, other." for i in range(40_000))

#: Nulls in every column, empty, odd and very long texts, ties, repeated rows and ids.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog and runs far away today", "en", "b", 1),
    (1, "the quick brown fox jumps over the lazy dog and runs far away today", "en", "b", 1),
    (2, "", "en", "a", 0),
    (3, None, "de", "a", None),
    (4, "  \t\n ", None, None, 3),
    (None, "a text without id that is long enough to have some words in it", "en", "a", 5),
    (None, None, None, None, None),
    (5, LONG, "en", "z", len(LONG)),
    (6, "the quick brown fox jumps over the lazy dog and runs far away today", "en", "é", 1),
    (7, "Ünï code spaces   and\r\nlines  <|endoftext|> x", "fr", "b", 1),
    (7, "same id, other text", "fr", "b", 1),
    (8, "x", "en", "c", 1),
    (9, "123 456 !!!", "en", "c", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns named like results and helpers."""
    from pyspark.sql import functions as F

    names = ["fp", "component_id", "size", "shard", "slot", "score", "row", "n_words", "copies", "_text"]
    return odd.withColumns({name: F.lit("clash") for name in names})
