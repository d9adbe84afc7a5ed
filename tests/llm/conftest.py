import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "text_key string, size string, key string, rank string, row string, _id string, print string"
)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang, source)``, with columns that clash."""

    def of(rows):
        full = [(*r, "en", "a")[:4] if len(r) == 2 else r for r in rows]
        return spark.createDataFrame([(*r, 0, *["x"] * 7) for r in full], SCHEMA)

    return of


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return [
        (1, "one two three four\nfive six seven eight", "en", "a"),
        (2, "one two three four\nother words in this line", "en", "a"),
        (2, "one two three four\nother words in this line", "en", "a"),
        (3, None, None, None), (4, "", "en", None), (5, "   \n\t ", None, "b"),
        (None, "one two three four\nnine ten eleven", "de", "b"), (None, None, None, None),
        (6, long, "en", "c"), (7, "x" * 50_000, "en", "c"), (8, "É é à\x1cb \x00 ü", "fr", "c"),
        (9, "one two three four", "en", "a"), (10, "word", "en", "Z"),
    ]
