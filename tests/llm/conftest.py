import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns with the names that operators use inside.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, node long, row string, spans string, size int, block int, g long, t int, s string, m string, carried string, pii_text string, kept string"


@pytest.fixture(scope="session")
def documents(spark, root):
    return spark.read.parquet(f"{root}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


def odd_rows():
    """Nulls in every column, empty and blank texts, no letters, ties, repeated rows, a long text."""
    long_text = "Anaconda river token=abcdefabcdefabcdef " * 3000 + "x" * 30000 + " end@mail.example.org"
    sentence = "the quick brown fox jumps over the lazy dog near the old stone bridge today"
    return [
        (1, sentence, "en", "a", 10),
        (2, sentence.upper(), "en", "a", 10),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \n\t ", "fr", "b", 4),
        (6, "12 345 -- ??? €", "fr", "b", 14),
        (7, long_text, "de", None, 1),
        (8, "one two", "en", "c", 7),
        (8, "one two", "en", "c", 7),
        (9, "one two", None, "c", 7),
        (None, sentence, "en", "a", 10),
        (None, None, None, None, None),
        (10, "a\x0bb\x0cc  d  e", "es", "b", 3),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, 7, "row", "x", 1, 2, 3, 4, "s", "m", "c", "p", "k") for r in odd_rows()]
    return spark.createDataFrame(rows, CLASHING)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
