import pytest

from tests.llm.cases import EDGES, SCHEMA


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and
    columns named like the operators' working columns."""
    rows = [(i, t, lang, source, None, 7, "other", "r", "k", "q", "m", "s", 5, "f", "h", 3, "c") for i, t, lang, source in EDGES]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.limit(0)
