"""Exact distinct counts that can be merged.

Numbers become bits of bitmaps, one for each group and each range of 32,768 numbers. Bitmaps of days can
be kept and put together to those of weeks or of everything, which plain distinct counts cannot. A bitmap takes
4 KB, so the numbers should be dense, as ids counted on from 1 are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE, BITS = "number_range", "bits"


def bitmaps(df: DataFrame, column: str, by: Mapping[str, Column] | Sequence[str] = ()) -> DataFrame:
    """``by``, RANGE and BITS: the numbers that occur in each group. Nulls are left out, as a count leaves them out.

    Map tasks send one bitmap per group and range.
    """
    named = by if isinstance(by, Mapping) else {c: F.col(c) for c in by}
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(*[c.alias(n) for n, c in named.items()], F.bitmap_bucket_number(column).alias(RANGE))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias(BITS))
    )


def merged(maps: DataFrame, by: Mapping[str, Column] | Sequence[str] = ()) -> DataFrame:
    """Bitmaps of coarser groups, out of those of ``bitmaps`` or ``merged``."""
    named = by if isinstance(by, Mapping) else {c: F.col(c) for c in by}
    return maps.groupBy(*[c.alias(n) for n, c in named.items()], RANGE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counted(maps: DataFrame, by: Sequence[str] = (), name: str = "distinct_count") -> DataFrame:
    """Distinct numbers of each group; without groups one row, also for no rows."""
    return maps.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("long").alias(name))
