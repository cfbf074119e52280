import pytest

EDGE = [
    (1, "", "en"), (2, None, "en"), (3, "   \n\t ", None), (4, "one", "en"), (5, "one", "fr"),
    (6, "the quick brown fox jumps over the lazy dog " * 3, "en"), (6, "the quick brown fox jumps over the lazy dog " * 3, "en"),
    (7, "l'été à la plage\nl'été à la plage\n\nfin", "fr"), (8, "日本語の文章です。" * 30, None), (9, "word " * 60_000, "en"),
    (None, "a row without an id", None), (10, "😀 <|endoftext|> x\x00y", "en"), (11, "x" * 50_000, "en"),
]


@pytest.fixture
def edge_docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like results."""
    rows = [(i, t, lang, "s", len(t or ""), "kept", 9.5, "other") for i, t, lang in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, predicted double, line string")


@pytest.fixture
def no_docs(edge_docs):
    return edge_docs.where("false")
