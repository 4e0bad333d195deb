"""Shared helpers of the subpackage: table scans and distributed ranks."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.operators.materialize import materialize, release
from kestrel.session import scratch_path
from kestrel.sources.tables import table

__all__ = ["materialize", "release", "scratch_path", "table", "ranked", "smallest", "total_rows", "importable", "pieces"]


def importable(spark: SparkSession) -> None:
    """Let Python workers of this session import the package from where the
    driver imported it (a cluster that ships the package needs nothing)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def pieces(batches, rows: int = 256):
    """Arrow batches (up to 64 MB each) in slices of a few rows, so that a task's
    Python objects and output batches stay small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def total_rows(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def smallest(df: DataFrame, key: Column, ties: list[str], n: int) -> DataFrame:
    """About the ``n`` rows of smallest ``key`` (a uniform 64-bit hash), never more.

    Rows beyond a cut that holds somewhat over ``n`` are left out before the sort,
    so the one task that ends it reads about ``n`` rows whatever the table's size."""
    keyed = df.withColumn("_key", key)
    total = total_rows(df)
    if total > n:
        share = min(1.0, (n + 6 * n ** 0.5 + 6) / total)
        keyed = keyed.where(F.col("_key") <= F.lit(min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64)))))
    return keyed.orderBy("_key", *ties).limit(n).drop("_key")


def ranked(df: DataFrame, by: list[str], key: Column, ties: list[str], value: Column | None = None,
           bits: int = 8) -> DataFrame:
    """Position of each row in its group in order of ``key`` (a uniform 64-bit
    hash) without gathering a group in one task.

    Rows are dealt into ``2**bits`` ranges of the key; ranges are counted (with
    partial aggregation), a running sum over at most ``2**bits`` rows a group
    gives each range its start, and only the rows of one range are sorted
    together. Adds ``position`` (from 0) and, with ``value``, ``before`` (the
    sum of the values of all earlier rows of the group). Null-safe on ``by``."""
    value = F.lit(0).cast("long") if value is None else value.cast("long")
    keyed = (df.withColumn("_key", key).withColumn("_value", value)
             .withColumn("_range", F.shiftrightunsigned("_key", 64 - bits)))
    counts = (keyed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"), F.sum("_value").alias("_v")))
    ahead = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_range").alias("_at"),
                           F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_first"),
                           F.coalesce(F.sum("_v").over(ahead), F.lit(0)).alias("_sum"))
    on = F.col("_range") == F.col("_at")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    within = Window.partitionBy(*by, "_range").orderBy("_key", *ties)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    out = keyed.join(starts, on).select(
        *df.columns,
        (F.col("_first") + F.row_number().over(within) - 1).alias("position"),
        (F.col("_sum") + F.coalesce(F.sum("_value").over(earlier), F.lit(0))).alias("before"))
    return out
