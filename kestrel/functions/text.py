"""Tokenizer columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_on_space(line: Column) -> Column:
    """Split a line on single spaces with the JVM ``String.split(" ")`` rule:
    trailing empty tokens are dropped, leading and inner ones kept; an empty
    line yields one empty token and an all-space line yields none."""
    trimmed = F.rtrim(line)
    return (F.when(line == F.lit(""), F.array(F.lit("")))
            .when(trimmed == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ")))


def lines_of(text: Column) -> Column:
    """Lines of a text blob (split on newline)."""
    return F.split(text, "\n")
