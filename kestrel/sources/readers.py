"""Readers for text, JSON, delimited, LibSVM and JDBC sources, plus parsing
of delimited text lines into typed columns with a side output of bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (S1). Lines end at line feeds alone, so
    other line terminators stay part of their line."""
    return spark.read.option("lineSep", "\n").text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines (S2); with ``schema`` the scan is typed and needs no
    inference pass (S3). Missing fields read as NULL."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   trim: bool = True) -> DataFrame:
    """Delimited text with a fixed schema (S5, S7, S8, S10)."""
    return (spark.read.schema(schema).option("sep", sep)
            .option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)
            .option("mode", "PERMISSIVE").csv(path))


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LibSVM file -> (label double, features vector) (S12)."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", str(num_features))
    return r.load(path)


def parse_delimited(lines: DataFrame, schema: T.StructType, sep: str = " ",
                    col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split text lines on ``sep`` into the typed columns of ``schema``.

    Returns ``(good, bad)``: a line is bad when its field count differs or a
    field fails its cast (``try_cast``), instead of aborting the whole job.
    Both outputs come from one projection; evaluate them in separate actions
    or cache the input."""
    parts = F.split(F.col(col), _regex_quote(sep))
    fields = [parts.getItem(i).try_cast(f.dataType).alias(f.name)
              for i, f in enumerate(schema.fields)]
    ok = (F.size(parts) == len(schema.fields))
    for i, f in enumerate(schema.fields):
        ok = ok & (parts.getItem(i).try_cast(f.dataType).isNotNull())
    tagged = lines.select(F.col(col).alias("_line"), ok.alias("_ok"), *fields)
    good = tagged.where("_ok").drop("_line", "_ok")
    bad = tagged.where(~F.col("_ok")).select(F.col("_line").alias(col))
    return good, bad


def parse_vector(lines: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """Space-separated doubles -> ``features`` ML vector (S9)."""
    from pyspark.ml.functions import array_to_vector
    arr = F.split(F.trim(F.col(col)), _regex_quote(sep)).cast("array<double>")
    return lines.select(array_to_vector(arr).alias("features"))


def parse_basket(lines: DataFrame, col: str = "value") -> DataFrame:
    """Space-separated basket -> distinct ``items`` array (S11)."""
    return lines.select(F.array_distinct(F.split(F.col(col), " ")).alias("items"))


def read_jdbc_range(spark: SparkSession, url: str, table: str, column: str,
                    lower: int, upper: int, num_partitions: int,
                    properties: dict | None = None) -> DataFrame:
    """Rows with ``lower <= column <= upper`` read in ``num_partitions``
    parallel range queries (S14). The bounds only split the work, so the
    range filter is added explicitly; it is pushed into every query."""
    df = spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                         numPartitions=num_partitions, properties=properties or {})
    return df.where(F.col(column).between(lower, upper))


def _regex_quote(sep: str) -> str:
    import re
    return re.escape(sep)
