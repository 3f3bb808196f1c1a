"""Latest rows per group and top-k lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of every group, as an aggregate; runs on a stream as well.

    Map tasks send one row per group. Nothing is sorted by the order columns,
    which makes it faster than a window.
    """
    return _picked(df, keys, F.max_by, order_by)


def oldest_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of every group."""
    return _picked(df, keys, F.min_by, order_by)


def _picked(df: DataFrame, keys: Sequence[str], pick, order_by: Sequence[str]) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others]) if others else F.struct(F.lit(1).alias("__none"))
    picked = df.groupBy(*keys).agg(pick(row, F.struct(*order_by)).alias("__row"))
    return picked.select(*[c if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def latest_per_group(df: DataFrame, key: str, order_by: Sequence[str], k: int = 1,
                     number: str = "recency") -> DataFrame:
    """The last ``k`` rows of every group, numbered 1 (newest) to k.

    ``order_by`` should end in a unique column. Map tasks send at most k rows per
    group, so a group that holds a third of the table still sends only a few.
    """
    if k == 1:
        return newest_per_group(df, [key], order_by).withColumn(number, F.lit(1))
    newest_first = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order_by])
    return df.withColumn(number, F.row_number().over(newest_first)).where(F.col(number) <= k)


def latest_pair(df: DataFrame, key: str, order_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Newest and second newest row of every group side by side.

    For each column ``c``: ``c`` and ``previous_c``. Groups with a single row
    drop out. The two rows are folded with an aggregate on the partitioning the
    numbering already has, in place of a self-join.
    """
    last_two = latest_per_group(df, key, order_by, 2)
    return pair_up(last_two, key, columns)


def pair_up(last_two: DataFrame, key: str, columns: Sequence[str], number: str = "recency") -> DataFrame:
    newest, older = F.col(number) == 1, F.col(number) == 2
    folded = []
    for c in columns:
        folded.append(F.max(F.when(newest, F.col(c))).alias(c))
        folded.append(F.max(F.when(older, F.col(c))).alias(f"previous_{c}"))
    return (
        last_two.groupBy(key).agg(F.max(number).alias("__rows"), *folded)
        .where(F.col("__rows") == 2).drop("__rows")
    )


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows by ``order``, which should end in a unique column."""
    return df.orderBy(*order).limit(k)


def with_position(top: DataFrame, order: Sequence[Column], position: str = "position") -> DataFrame:
    """Number the rows of a list that ``top_k`` has already cut to k rows."""
    return top.withColumn(position, F.row_number().over(Window.orderBy(*order)))
