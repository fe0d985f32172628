import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: nulls, empty and long texts, ties and repeated rows, and columns whose names the operators use themselves
ODD = [
    (1, "the same words again and again and again", "en", "a", 1),
    (1, "the same words again and again and again", "en", "a", 1),
    (2, "The  same words\tagain and again and again", "en", None, 2),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n ", "en", "a", 3),
    (None, "no name at all", "en", "a", 4),
    (None, "no name at all", "en", "a", 4),
    (6, "é ü 日本語 😀 \x1c x", "xx", "b", 9),
    (7, "word " * 30000, "en", "b", 150000),
    (8, "one two three four five six", "en", "b", 20),
    (8, "another text under the same number", "en", "b", 20),
]


@pytest.fixture
def odd(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ODD, DOCS)
    clash = ("kept", "score", "slot", "size", "digest", "file", "row", "length", "offset", "component", "ids", "_row", "text_crc32")
    return frame.select("*", *[F.lit("mine").alias(c) for c in clash])


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (8, 0, 1), (None, 1, 1), (99, None, None)], "doc_id long, quality int, toxic int")
