import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash."""

    def make(rows):
        rows = [(i, t, "x", 1, 2) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, key string, size int, component_id int")

    return make


NASTY = [
    (0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One two three"), (4, "One two three"),
    (5, "a b c d e f g h i j " * 3), (6, "É ê   😀 word next"), (7, "x" * 5000), (8, "w " * 3000),
    (None, "no id at all here"), (9, "#$%&*<>|" * 20), (10, "tab\tand\x0bvt\x0cff\rcr"),
]


@pytest.fixture(scope="session")
def nasty():
    return NASTY
