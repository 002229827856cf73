"""Small tables with every odd case the operators define."""

import pytest

LONG = " ".join(f"word{i % 977}" for i in range(40_000))
PROSE = "the cat and the dog sat on the mat with a hat while the rain fell on the roof of the old house by the sea " * 3
EDGE_ROWS = [
    (1, PROSE), (2, PROSE), (2, PROSE), (3, PROSE.upper()), (4, ""), (5, None), (6, " \t\n "), (7, LONG),
    (None, PROSE), (None, None), (8, "\x00 nul ▁ mark"), (9, "123 456 !!! ###"), (10, "é ü ß 日本語 😀 é"), (11, "one"),
]
# Extra columns under names that the operators use themselves.
CLASHING = ("id", "n", "digest", "token", "words", "found", "component", "score", "h", "path", "version", "ids", "start", "gone", "again", "__id", "__digest", "__findings")


@pytest.fixture(scope="module")
def edge(spark):
    extra = tuple(f"x{i}" for i in range(len(CLASHING)))
    rows = [(*r, "en", *extra) for r in EDGE_ROWS]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def empty(edge):
    return edge.limit(0)


@pytest.fixture
def docs_of(spark):
    def make(texts, first=0):
        return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return make


def rows_of(df):
    return [tuple(r) for r in df.collect()]
