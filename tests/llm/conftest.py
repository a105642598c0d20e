import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, spans string, "
    "component_id string, rank string, keep_id string, task string, host string, row string, _digest string"
)
LONG = "word " * 30_000 + "x" * 40_000


@pytest.fixture(scope="session")
def edges(spark):
    """Null, empty and very long texts, null columns, ties, repeated rows, clashing column names."""
    texts = {
        1: None, 2: "", 3: " \n\t ", 4: LONG, 5: "One two three four five six.", 6: "one TWO three four five six.",
        7: "One two three four five six.", 8: "...", 9: "Éa ß 漢字 <|endoftext|> ok", 10: LONG,
    }
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else "h", None, *["x"] * 9) for i, t in texts.items()]
    rows += [rows[4], rows[4], (None, "One two three four five six.", None, None, None, *[None] * 9), (None, None, None, None, None, *[None] * 9)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
