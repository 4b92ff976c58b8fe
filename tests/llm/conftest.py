import pytest

from cellspark.llm.common import ship

TEXTS = [
    "The cat sat on the mat and looked at the dog in the garden.",
    "",
    None,
    "word " * 3000,
    "The cat sat on the mat and looked at the dog in the garden.",
    "Größe und Straße\tmit\nZeilen\n\nund über die Brücke nach Hause",
    "x" * 20000,
    "\n \t\n",
]


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture
def make(shipped):
    """Documents with extra columns whose names clash with results; the first row comes twice."""

    def build(texts, schema="doc_id long, text string, lang string, score double, n_words string, n string, leaks string"):
        rows = [(i, t, "en", 0.5, "clash", "clash", "clash") for i, t in enumerate(texts)]
        return shipped.createDataFrame(rows + rows[:1], schema)

    return build


@pytest.fixture
def odd(make):
    """Null, empty, long, repeated and blank texts, and a null id."""
    docs = make(TEXTS)
    return docs.unionByName(docs.sparkSession.createDataFrame([(None, "no id here at all", None, None, None, None, None)], docs.schema))


@pytest.fixture
def empty(make):
    return make(TEXTS).where("false")
