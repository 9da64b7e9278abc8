import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, source, lang) of the smallest table."""
    import pyarrow.parquet as pq

    t = pq.read_table(os.path.join(SF, "documents.parquet")).to_pydict()
    return list(zip(t["doc_id"], t["text"], t["source"], t["lang"]))


@pytest.fixture(scope="session")
def docs(spark):
    from flowlens.llm.common import ship

    return ship(spark).read.parquet(os.path.join(SF, "documents.parquet"))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeats."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(60_000)) + "\n"
    return [
        (1, None, None, None), (2, "", "a", "en"), (3, " \n\t ", "a", "en"), (4, "one two", None, "en"),
        (5, "ONE two", "b", None), (6, long, "b", "en"), (7, long + "tail", "b", "en"), (8, "é ß 漢字 🙂 " * 30, "a", "fr"),
        (9, "é ß 漢字 🙂 " * 30, "a", "fr"), (10, "### $$$ %%%", "c", "en"), (11, "same line\n" * 40, "c", "en"),
        (12, "12345 67890", "c", "de"), (12, "12345 67890", "c", "de"), (None, "a text without an id", "a", "en"),
        (13, "x" * 5000, "a", "en"), (14, "<|endoftext|> a\r\n\r\nb", "a", "en"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with an extra column named like an inner one."""
    from flowlens.llm.common import ship

    full = [(i, t, s, l, len(t or ""), 7) for i, t, s, l in odd_rows]
    return ship(spark).createDataFrame(
        full, "doc_id long, text string, source string, lang string, n_chars long, size int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("1 = 0")
