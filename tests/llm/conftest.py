import pytest

EDGE_TEXTS = [
    None, "", " ", "\t\r\n", "one", "one two", "one two three", "one  two three", "ONE two Three", "ÉÀ ßx 日本 text",
    "word " * 3000, "x" * 20000, "a\x0bb\x0cc", "same text here", "same text here", "sametext here", "\U0001f600 smile \U0001f600",
]


@pytest.fixture
def edge_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns with clashing names."""
    rows = [(i, text, "en", f"s{i % 4}", None if text is None else len(text), i, "x") for i, text in enumerate(EDGE_TEXTS)]
    rows += [(3, None, None, None, None, None, None), (None, "same text here", None, None, 5, 1, "y"), (2, " ", "en", "s2", 1, 2, "x"), (2, " ", "en", "s2", 1, 2, "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, digest string")


@pytest.fixture
def no_documents(edge_documents):
    return edge_documents.where("false")
