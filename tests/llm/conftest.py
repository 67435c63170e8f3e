from __future__ import annotations

import pytest

#: Nulls, an empty text, repeated rows, a very long text, and columns whose names operators use themselves.
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_tokens STRING, row STRING, fp STRING, shard STRING"


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "a b c d e a b c\nx\nx\n\nx"), (6, "a b c d e a b c\nx\nx\n\nx"),
        (None, "no id here"), (8, "É\x1cu  ΣΑΣ \n y ﬁ 中文 1234 don't <|endoftext|>"), (9, "word " * 30_000), (10, "x" * 50_000), (4, "one"),
    ]
    values = [(i, t, None if i == 2 else "en", None if i == 3 else "s", "n", "r", "f", "s") for i, t in rows]
    return spark.createDataFrame(values, SCHEMA)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.filter("false")
