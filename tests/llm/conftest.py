import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `rank` int, text_sha256 string, _key long, chunk string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and further columns with names that operators use."""
    a = "the quick brown fox jumps over the lazy dog again and again until night falls on the quiet hills of home"
    b = a.replace("quiet", "silent")
    long = " ".join(f"w{i % 997}x{i}" for i in range(40_000))
    texts = [(1, a), (2, a.replace(" ", "  \t")), (3, b), (3, b), (4, None), (5, ""), (6, " \n "), (None, a), (None, None), (7, long), (8, long + " end"), (9, "one two"), (10, "One TWO"), (11, "Ünïcode été ÉTÉ 12 it's <|endoftext|>  x")]
    rows = [(i, t, None if k == 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None if k % 5 == 0 else len(t or ""), k, "x", k, "c") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
