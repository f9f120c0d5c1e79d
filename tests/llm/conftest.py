import pytest

SF = "/root/testdata/sf0.001"

#: Nulls, blanks, ties, repeated rows and long texts, with a column that has the name of a result.
ROWS = [
    (1, "a b c a b c a b c", "s1", 9),
    (1, "a b c a b c a b c", "s1", 9),
    (2, None, "s1", 9),
    (3, "", None, 9),
    (4, " \t\n ", "s2", 9),
    (None, "one two three four", None, 9),
    (5, "x " * 3000, "s2", 9),
    (6, "Line one here\nLine one here\nother line\n\n", "s3", 9),
    (7, "é ü ñ 漢字 \U0001f600 # * $", "s3", 9),
    (8, "one two three four", "s1", 9),
    (9, " ".join(f"w{i}" for i in range(200)), "s1", 9),
    (10, " ".join(f"w{i}" for i in range(200)), "s2", 9),
    (2**60 + 1, "large identifier, that no double holds", "s2", 9),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string, shard int").repartition(3)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
