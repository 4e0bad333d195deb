"""Word counting over text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.text import lines_of, split_on_space


def words(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row per token of every line (``word`` column)."""
    return lines.select(F.explode(split_on_space(F.col(col))).alias("word"))


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """(word, n) for every token. The count is partially aggregated in each
    task, so a very frequent word costs one row per task in the shuffle."""
    return words(lines, col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def document_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Text-scan shape (``value``) from a table of whole documents."""
    return docs.select(F.explode(lines_of(F.col(text_col))).alias("value"))


def word_count_lines_text(counts: DataFrame) -> DataFrame:
    """``(word,n)`` text lines, the saved-text layout of a word count. Line feeds
    and backslashes of a word are escaped, so a word never breaks its line."""
    word = F.replace(F.replace("word", F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return counts.select(F.format_string("(%s,%d)", word, "n").alias("value"))


def parse_word_count_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """(word, n) back from :func:`word_count_lines_text` lines."""
    m = r"(?s)^\((.*),([0-9]+)\)$"
    # An escaped backslash is set aside while line feeds are restored.
    word = F.replace(F.regexp_extract(col, m, 1), F.lit("\\\\"), F.lit("\x00"))
    word = F.replace(F.replace(word, F.lit("\\n"), F.lit("\n")), F.lit("\x00"), F.lit("\\"))
    return lines.select(word.alias("word"), F.regexp_extract(col, m, 2).cast("bigint").alias("n"))
