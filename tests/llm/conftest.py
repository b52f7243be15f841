from __future__ import annotations

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, `key` string, node string, "
          "part string, ids string, rank string, term string")


@pytest.fixture(scope="session")
def make(spark):
    """Documents with further columns whose names the operators use inside."""
    def build(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), *["x"] * 7) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)
    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, a null id, a very long text, repeated rows, ties, unusual characters."""
    return [
        (5, None), (1, ""), (2, " \n\t "), (None, "no id here"), (3, "The the  THE,\n\n\nthe. it's 42x \u00e9t\u00e9 \u00c9T\u00c9"),
        (3, "The the  THE,\n\n\nthe. it's 42x \u00e9t\u00e9 \u00c9T\u00c9"), (9, "word " * 30_000), (10, "x" * 5000),
        (11, "<|endoftext|>a<|startoftext|> <|EndOfText|>"), (12, "\u0130x| \u03a3a\u03a3 e\u0301 \u4e2d\u6587\u00a0z\x1cy"), (4, "one"), (-7, "a b c d e"),
    ]
