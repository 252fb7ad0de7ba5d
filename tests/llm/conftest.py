import pytest
from samples import LONG, PROSE, SF_DIR


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [
        (1, PROSE, "x", 1.0),
        (2, None, None, None),
        (3, "", "x", 1.0),
        (4, " \t\n ", "x", 1.0),
        (5, LONG, "x", 1.0),
        (6, LONG + " end", "x", 1.0),
        (7, PROSE, "x", 1.0),
        (7, PROSE, "x", 1.0),
        (None, PROSE, "x", 1.0),
        (8, "a", "x", 1.0),
        (9, "é中🎉 ünï " + PROSE, "x", 1.0),
    ]
    return spark.createDataFrame(
        [(i, t, a, b, "k", 5) for i, t, a, b in rows],
        "doc_id bigint, text string, words string, score double, row string, part int",
    )


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (7, 1, None), (None, 1, 1), (8, None, 1), (8, 0, 1)], "doc_id bigint, quality int, toxic int"
    )
