import pytest

KEY = "a key for tests"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, owner string, fp string, score string, src string, key string, size string, keys string, hot string"


@pytest.fixture(autouse=True)
def workers(spark):
    from rebuy.llm.pii import KEY_SETTING
    from rebuy.llm.shared import on_workers
    on_workers(spark)
    spark.conf.set(KEY_SETTING, KEY)


@pytest.fixture
def docs_of(spark):
    """(doc_id, text[, lang, source]) rows -> documents with extra columns
    whose names clash with those the operators use inside."""
    def make(rows):
        full = []
        for r in rows:
            doc, text, lang, source = (*r, *[None] * (4 - len(r)))
            full.append((doc, text, lang, source, None if text is None else len(text), *["x"] * 8))
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture
def awkward(docs_of):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    base = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of old leaves "
    return docs_of([
        (1, base * 4, "en", "a"), (2, base * 4, "en", "a"), (2, base * 4, "en", "a"), (3, "", "en", None), (4, None, None, "b"),
        (None, base * 4, "en", "b"), (None, None, None, None), (5, "  \t\n ", "de", "a"), (6, "é" * 700, "fr", "c"),
        (7, "word " * 30000, "en", "c"), (8, "12345", None, "c"), (9, base[::-1] * 3, "de", "d"), (2, "another text", "en", "b")])
