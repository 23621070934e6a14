import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and long texts, equal rows, shared ids, and columns that others might use."""
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    rows = [
        (1, "one two three four five six", "a", 1),
        (1, "one two three four five six", "a", 1),
        (2, "one two three four five six", None, 2),
        (3, None, "a", None),
        (4, "", "b", 0),
        (5, " \t\n ", "b", 0),
        (None, "no id at all", "b", 7),
        (6, long, "b", 7),
        (7, long + " tail", None, 7),
        (2, "another text under a known id", "a", 5),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, id int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
