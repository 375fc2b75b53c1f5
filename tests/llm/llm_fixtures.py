import pandas as pd
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A ``documents`` table of (id, text[, lang[, source]]) rows, dealt to a few partitions."""

    def build(rows, extra=""):
        full = [(r + (None,) * (4 - len(r)))[:4] for r in rows]
        full = [(*r, len(r[1]) if r[1] is not None else None) for r in full]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return build


@pytest.fixture(scope="session")
def sample():
    """The documents of the smallest scale, with labels, as pandas."""
    base = "/root/testdata/sf0.001"
    docs = pd.read_parquet(f"{base}/documents.parquet")
    return docs.merge(pd.read_parquet(f"{base}/labels.parquet"), on="doc_id", how="left")


#: Rows that every operator must survive: nulls, blanks, repeats, ties, odd characters, a very long text.
HARD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n\r ", "en", "a"), (4, "one", "en", None), (5, "one", "en", "b"),
    (6, "one two", "de", "b"), (6, "one two", "de", "b"), (7, "word " * 30_000, "en", "a"), (8, "x" * 150_000, "fr", "c"),
    (9, "é́\U0001f600   \x1c nul\x00 ok", "fr", "c"), (10, "123 456 !!", None, "c"), (11, "a b c d e f g h i j", "en", "é"),
]
