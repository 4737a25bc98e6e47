import pytest

LONG = "lorem ipsum dolor " * 20_000 + "x" * 70_000
CLASHES = ("digest", "tag", "keep_id", "kept", "spans", "t1", "n", "fp", "shard", "key", "best", "score", "label", "part", "ids")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture(scope="session")
def table(spark):
    """Rows of (doc_id, text) as a documents table with columns whose names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, None, None, None, *CLASHES) for i, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, repeated rows, repeated ids and equal texts."""
    return [(1, None), (2, ""), (3, "a"), (4, "a"), (4, "a"), (5, LONG), (6, LONG), (7, "one two three"), (None, "one two three"),
            (None, None), (8, " \t\n "), (9, "one two  three"), (10, "é ß 漢字 😀"), (10, "another text")]


@pytest.fixture(scope="session")
def edge(table, edge_rows):
    return table(edge_rows).cache()


@pytest.fixture(scope="session")
def nothing(table):
    return table([])
