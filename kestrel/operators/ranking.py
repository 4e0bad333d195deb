"""Ordering operators: global top-k and top-k within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order``. ``orderBy(...).limit(k)`` plans as
    TakeOrderedAndProject: each task keeps only its k best rows, so no full
    sort or range shuffle of the input happens."""
    return df.orderBy(*order).limit(k)


def rank_per_group(df: DataFrame, keys: Sequence[str], order_col: str, k: int,
                   ascending: bool = False, tie_break: Sequence[str] = (),
                   rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each group by ``order_col`` (descending by
    default), ties broken by ``tie_break`` ascending. ``row_number <= k`` over
    a window is planned with WindowGroupLimit, which trims every group to k
    rows before the shuffle, so a huge group never lands whole in one task."""
    primary = F.asc(order_col) if ascending else F.desc(order_col)
    w = Window.partitionBy(*keys).orderBy(primary, *[F.asc(c) for c in tie_break])
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= k))


def nest(df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str = "value") -> DataFrame:
    """Reshape to ``(keys..., name: struct<cols...>)`` (the nested
    key/(a, b) pair layout). Plans stay flat; this is for consumers that want
    the nested record."""
    return df.select(*keys, F.struct(*cols).alias(name))
