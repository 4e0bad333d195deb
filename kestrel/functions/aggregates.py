"""Aggregate Column factories.

User-defined aggregates are expressed as built-in aggregate expressions so
Spark keeps partial (map-side) aggregation and codegen; a Python grouped
aggregate would send every row of a group to one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def average(col: str | Column) -> Column:
    """Mean as double from a (sum, count) buffer; NULLs are skipped and no
    rows give NULL (SQL meaning)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).cast("double") / F.count(c)


def int_average(col: str | Column) -> Column:
    """Integer quotient (truncated, like ``div``) of sum and count: the
    (sum, count) pair aggregate with an integer result. Exact for any bigint
    sum, since it avoids a floating-point division."""
    c = F.col(col) if isinstance(col, str) else col
    s = F.sum(c).cast("bigint")
    n = F.count(c)
    return F.when(n > 0, ((s - s % n) / n).cast("bigint"))


def fold_by_key(df: DataFrame, keys: list[str], value: str, zero: str, seq: Callable[[Column, Column], Column],
                comb: Callable[[Column, Column], Column], finish: Callable[[Column], Column] | None = None,
                out: str = "result", piece_rows: int = 4096) -> DataFrame:
    """Two-function aggregation per key: ``seq(acc, value)`` folds values from
    ``zero`` (SQL text of the start value with its type) and ``comb(acc, acc)`` joins
    partial results; neither may depend on order.

    Rows are dealt by hash into pieces of about ``piece_rows``, folded, and the
    partial results joined ``piece_rows`` at a time until one a key is left, so no
    list in memory grows with the key's rows."""
    start = F.expr(zero)
    pieces = max(1, -(-df.count() // piece_rows))
    acc = (df.groupBy(*keys, F.pmod(F.xxhash64(*df.columns, F.rand(1)), F.lit(pieces)).alias("_piece"))
           .agg(F.aggregate(F.collect_list(value), start, seq).alias("_acc")))
    while pieces > 1:
        pieces = -(-pieces // piece_rows)
        acc = (acc.groupBy(*keys, F.floor(F.col("_piece") / piece_rows).alias("_piece"))
               .agg(F.aggregate(F.collect_list("_acc"), start, comb).alias("_acc")))
    return acc.select(*keys, (finish(F.col("_acc")) if finish else F.col("_acc")).alias(out))


def histogram(df: DataFrame, col: str, count_col: str = "n") -> DataFrame:
    """Value histogram as rows (value, n)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))


def histogram_map(df: DataFrame, col: str) -> DataFrame:
    """The histogram as one ``map<value, bigint>`` row. Size is the number of
    distinct values, so use it only on low-cardinality columns."""
    h = histogram(df, col)
    return h.agg(F.map_from_entries(F.collect_list(F.struct(F.col(col), F.col("n")))).alias("histogram"))


def observed_counts(df: DataFrame, col: str, values: list) -> tuple[DataFrame, Callable[[], dict]]:
    """``df`` and a function that gives the counts of ``values`` in ``col`` once an action
    on the returned frame has run: a map {value: n, ..., None: rows with any other value
    or none}, observed while the rows pass by. No further scan or shuffle; each task
    counts for itself, and a task that is run again is counted once. The map has as many
    entries as ``values``, so pass a bounded list."""
    seen = Observation()
    known = [F.count_if(F.col(col).eqNullSafe(F.lit(v))).alias(f"n{k}") for k, v in enumerate(values)]
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *known)

    def counts() -> dict:
        got = seen.get
        out = {v: got[f"n{k}"] for k, v in enumerate(values)}
        out[None] = got["rows"] - sum(out.values())
        return out

    return watched, counts


def register_average_udaf(spark: SparkSession, name: str = "average") -> None:
    """Register ``name(sum(x), count(x))`` as a temporary SQL function: the last
    step of an average over a (sum, count) buffer. The buffer itself is kept by
    the built-in aggregates, so it is merged partially in each task and no group is
    gathered (a Python aggregate would send every group whole to one task)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s DOUBLE, n BIGINT) RETURNS DOUBLE "
              "RETURN CASE WHEN n > 0 THEN s / n END")
