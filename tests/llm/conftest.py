import pytest

#: Null, empty, blank, tiny and long texts, ties and repeated rows, and an
#: extra column whose name clashes with working names.
ODD = [
    (1, None, "en", "s", 0),
    (2, "", "en", None, 0),
    (3, " \n\t ", None, "s", 4),
    (4, "a", "en", "s", 1),
    (5, "one two three", "xx", "s", 13),
    (5, "one two three", "xx", "s", 13),
    (None, "one two three", "en", "s", 13),
    (6, "Ünï 中文 ſK ΑΣ é don't 123", "de", "s", None),
    (7, "long " * 40_000, "en", "s", 200_000),
    (8, "x" * 60_000, "en", "s", 60_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    out = df.selectExpr("*", "'clash' AS ids", "1 AS fp", "2L AS root", "'k' AS key", "3 AS row", "'w' AS words", "0 AS n")
    return out.cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
