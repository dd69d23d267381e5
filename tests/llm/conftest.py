import pytest

EXTRA = (
    "doc_id long, text string, lang string, source string, row string, scan string, kept string,"
    " `key` string, words string, n_words string, n_mentions string, label string, group string"
)
FILL = ("x",) * 9


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with extra columns
    whose names operators use themselves."""

    def build(*rows):
        full = [(*r, "en", "s")[:4] + FILL if len(r) == 2 else (*r, *FILL) for r in rows]
        return spark.createDataFrame(full, EXTRA)

    return build


LONG = " ".join(f"w{i}" for i in range(60_000))
EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, LONG),
    (5, "one two three"),
    (5, "one two three"),
    (None, "a text without an id, but with words"),
    (6, None, None, None),
    (7, "some words here", None, None),
]


@pytest.fixture
def edges(documents):
    return documents(*EDGES)


@pytest.fixture
def nothing(documents):
    return documents((0, "x")).limit(0)
