import pytest

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"

#: Rows every operator must stand: nulls, empty and blank texts, very long
#: texts, ties, repeated rows, and a null id.
LONG = ("lorem ipsum dolor sit amet consectetur " * 6000).strip()
EDGE = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "  \n\t ", None, None),
    (4, "one two three", "en", "b"), (4, "one two three", "en", "b"),
    (5, LONG, "en", "b"), (6, LONG + " end", "en", None),
    (None, "a null id with a few words in it", "de", "a"),
    (7, "Mixed Case words here and some more of them", "fr", "c"),
    (8, "mixed case WORDS here and some more of them", "fr", "c"),
    (9, "x" * 50_000, None, "c"), (10, "éß中文 \U0001f600 ok", "zh", "d"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows with extra columns whose names the operators use inside."""
    rows = [(*r, 1, "x", -5, "q") for r in EDGE]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, size int,"
              " token string, rank int, `odd name.x` string")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")
