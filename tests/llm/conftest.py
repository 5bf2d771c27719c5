import pytest

EXTRA = ", word string, base string, ids string, _rate double, held_out string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    rows = [
        (1, "Hello world, hello!", "en"), (2, None, "en"), (3, "", None), (4, "Hello world, hello!", "en"), (None, "no id here", None), (None, None, None),
        (7, "x" * 50_000, "en"), (8, "a b\n" * 20_000, "en"), (9, " \t\n   ", "fr"), (9, " \t\n   ", "fr"), (9, "other text with id nine", "de"),
        (10, "é" * 300 + " ñandú 中文 😀 \x00 end", "es"), (11, "mail me: jo.e@mail.example.com or 10.1.2.3 or +1 (988) 555-2485 now", "en"),
    ]
    made = [(i, t, l, None, None, "w", "b", "i", 0.5, "h") for i, t, l in rows]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long" + EXTRA)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 1, 1), (4, None, 0), (None, 1, 1), (7, None, None), (11, 1, 0)], "doc_id long, quality int, toxic int")
