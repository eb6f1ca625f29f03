import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 6000
PROSE = "A quick survey of the river shows that water levels rise each spring, when snow melts in the hills and small streams fill. "


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    return [
        (1, PROSE * 3, "en", "b", 300), (2, PROSE * 3, "en", "a", 300), (2, PROSE * 3, "en", "a", 300), (2, "another text under the same id", "en", None, 5),
        (None, PROSE, "en", "a", None), (None, None, None, None, None), (3, None, "de", "a", 0), (4, "", None, "b", 0), (5, " \n\t ", "fr", "c", 4),
        (6, LONG, "en", "c", len(LONG)), (7, LONG, "en", "c", len(LONG)), (8, "Ein kurzer Satz über Größe, Maß und Straße.", "de", "zé", 42),
        (9, "日本語の文章です。短いけれど意味があります。", "ja", "\U0001f600", 20), (-5, "negative id", "en", "", 1), (1 << 62, "large id\x00with\x1codd signs <|endoftext|> x", "en", "b", 2),
    ]


@pytest.fixture
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
