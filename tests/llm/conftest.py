"""Small stored tables for the operators on text."""

import uuid

import pytest

KINDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns that the operators do not know, named like ones they make themselves.
CLASHES = ("_row", "key", "n", "kept", "score", "removed", "words", "matches", "spans", "line")
ODD_TEXTS = (None, "", " \n\t ", "x" * 200_000, "\n" * 1_000, "one", "ß é 語 \U0001f600\nzwei", "a b " * 20_000)


@pytest.fixture
def stored_docs(spark, tmp_path):
    """Write texts as a documents table and read it back; ids count from 0."""

    def make(texts, ids=None, sources=None, clash=False):
        ids = list(range(len(texts))) if ids is None else ids
        sources = sources or ["s"] * len(texts)
        rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources, strict=True)]
        df = spark.createDataFrame(rows, KINDS)
        if clash:
            df = df.selectExpr("*", *[f"'c' AS `{name}`" for name in CLASHES])
        path = str(tmp_path / uuid.uuid4().hex)
        df.write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def odd_docs(stored_docs):
    """Nulls, empty and very long texts, repeated rows, a repeated and a null id."""
    texts = [*ODD_TEXTS, "one two three four five six", "one two three four five six", "same row", "same row"]
    ids = [*range(len(ODD_TEXTS)), 90, 90, None, None]
    return stored_docs(texts, ids, clash=True)
