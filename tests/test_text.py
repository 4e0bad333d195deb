from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.functions.text import split_on_space
from kestrel.operators import text


def java_split_space(s: str) -> list[str]:
    """Python model of the JVM rule: split on every space, then drop trailing
    empty strings; an empty input gives one empty token."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_tokenizer_edge_cases(spark):
    df = spark.createDataFrame([("",), (" ",), ("a  b ",), (" a",)], "v string")
    got = [r[0] for r in df.select(split_on_space(F.col("v"))).collect()]
    assert got == [[""], [], ["a", "", "b"], ["", "a"]]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=8), min_size=1, max_size=10))
def test_tokenizer_matches_jvm_split(spark, lines):
    df = spark.createDataFrame([(s,) for s in lines], "v string")
    got = [r[0] for r in df.select(split_on_space(F.col("v"))).collect()]
    assert got == [java_split_space(s) for s in lines]


def test_word_count(spark):
    lines = spark.createDataFrame([("a b a",), ("b ",), ("",)], "value string")
    got = {r["word"]: r["n"] for r in text.word_count(lines).collect()}
    assert got == {"a": 2, "b": 2, "": 1}


def test_document_lines_and_text_layout(spark):
    docs = spark.createDataFrame([("x y\nx",)], "text string")
    counts = text.word_count(text.document_lines(docs))
    assert sorted(r[0] for r in text.word_count_lines_text(counts).collect()) == ["(x,2)", "(y,1)"]
