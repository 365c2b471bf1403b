import pytest

from gridtide.llm.shared import ready

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return ready(spark)


@pytest.fixture
def documents(llm):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns that clash with the operators' own."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "a")), len(r[1] or "")) for r in rows]
        frame = llm.createDataFrame(full, SCHEMA)
        return frame.selectExpr("*", "'x' AS score", "1 AS key", "2 AS node", "3 AS size", "4 AS words")

    return make


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, "one"),
    (5, "The same line of text stands here twice.\nThe same line of text stands here twice."),
    (5, "The same line of text stands here twice.\nThe same line of text stands here twice."),
    (None, "A text whose id is not known at all, éàü ÉÀÜ."),
    (7, "long " * 30_000),
    (8, "x" * 70_000),
    (9, "tie tie tie tie tie tie tie tie tie tie", None, None),
]


@pytest.fixture(params=["odd", "empty"])
def odd(request, documents):
    """NULLs in any column, empty and very long texts, ties and repeated rows; and no rows at all."""
    return documents(ODD if request.param == "odd" else []), len(ODD) if request.param == "odd" else 0
