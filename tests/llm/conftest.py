from __future__ import annotations

import pytest
from corpus_support import prose

CLASHING = "lang string, source string, n_chars long, size long, shard int, score double, lang_pred string, bits long, fingerprint string, row long, item long, entities string, `a b` int"


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    long_text = prose(1, 40_000)
    texts = [
        (1, "Plain words of a text, and some more words."), (2, None), (3, ""), (4, " \t\n"), (5, long_text), (6, "x" * 30_000),
        (7, "Plain words of a text, and some more words. "), (8, "日本語 текст ελληνικά 😀"), (8, "日本語 текст ελληνικά 😀"), (None, "no id"), (None, None),
        (9, "Plain words of a text, and some more words."), (8, "another text with the same id"), (10, "12 345 !!"), (11, "<|endoftext|> and </s>"),
    ]
    return [(i, t, "en" if k % 3 else None, None, None if k % 2 else k, k, None, 0.5, "zz", None, "f", 1, 2, None if k % 4 else "e", 3) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), f"doc_id long, text string, {CLASHING}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], f"doc_id long, text string, {CLASHING}")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
