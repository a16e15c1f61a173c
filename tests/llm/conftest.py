import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet, consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua "


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) pairs, with the columns of the table and some whose names operators might use."""

    def make(rows):
        full = [(i, t, None, None if t is None else "s", None, "x", 1.5, 7, None) for i, t in rows]
        return spark.createDataFrame(full, COLUMNS + ", name string, score double, key int, spans string")

    return make


@pytest.fixture(scope="session")
def awkward(documents):
    """Null ids, null, empty, blank and very long texts, ties and repeated rows."""
    words = " ".join(f"w{i}" for i in range(30_000))
    return documents(
        [(1, LONG), (1, LONG), (2, LONG), (3, None), (4, ""), (5, " \n\t "), (None, LONG), (None, None), (6, words), (7, "x" * 50_000), (8, "one two"), (9, "a@b.cd +1 (234) 555-7777")]
    )


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
