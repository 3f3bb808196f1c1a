"""Series laid out by their key, so that work on each key needs no shuffle.

A table is hashed into buckets by its key and sorted by key and time inside, the layout that an index on both
stands for. Newest rows, pairs of readings and differences then run where the rows lie. All rows of a key are in one
bucket: for keys that may hold a large part of all rows, ``history.deltas`` cuts them up instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def save_bucketed(df: DataFrame, table: str, key: str, order_by: Sequence[str], buckets: int = 64,
                  path: str | None = None, mode: str = "error") -> None:
    """Write ``df`` as a table of one sorted file per bucket; ``path`` names its folder, else the warehouse holds it."""
    writer = df.repartition(buckets, key).write.format("parquet").mode(mode).bucketBy(buckets, key).sortBy(key, *order_by)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def sorted_deltas(df: DataFrame, key: str, order_by: Sequence[str], measures: Sequence[str], prefix: str = "delta_") -> DataFrame:
    """Every measure minus its value in the row before, 0 in a key's first row; one pass over each bucket."""
    window = Window.partitionBy(key).orderBy(*order_by)
    return df.withColumns({prefix + m: F.col(m) - F.lag(m, 1).over(window) for m in measures}).withColumns(
        {prefix + m: F.when(F.row_number().over(window) == 1, F.col(m) - F.col(m)).otherwise(F.col(prefix + m)) for m in measures})
