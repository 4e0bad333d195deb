import pytest

from kestrel.llm.common import importable

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Rows -> documents; extra columns may follow (name, type, value)."""
    importable(spark)

    def make(rows, extra=()):
        schema = ", ".join([DOC, *(f"{name} {kind}" for name, kind, _ in extra)])
        full = [(i, t, "en", s, None if t is None else len(t), *(v for _, _, v in extra)) for i, t, s in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return make


@pytest.fixture
def odd(docs):
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    rows = [(1, "the cat sat on the mat today", "a"), (1, "the cat sat on the mat today", "a"), (2, None, "a"),
            (3, "", None), (None, "the cat sat on the mat today", "b"), (None, None, None), (4, " \n\t ", "b"),
            (5, "word " * 30_000, "b"), (6, "\U0001f600 été 漢字 it's 3", "a")]
    clash = [("score", "string", "x"), ("fp", "string", "y"), ("shard", "int", 7), ("slot", "int", 7), ("ids", "string", "z"),
             ("part", "string", "w"), ("component_id", "string", "v"), ("size", "string", "u"), ("target", "string", "t"),
             ("start", "string", "s"), ("label", "string", "r"), ("row", "string", "q"), ("block", "string", "p"),
             ("position", "string", "o"), ("path", "string", "n"), ("guest", "string", "m"), ("text_key", "string", "l")]
    return docs(rows, clash)
