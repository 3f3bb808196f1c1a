"""Tables laid out for look-ups of single keys.

Rows are cut by ranges of a key into files and sorted inside, so the statistics of files and of row groups leave only
a few to read for one key, or for one key and a span of time. Other columns get Bloom filters, which do the same for
values that stand anywhere. Readers are plain Parquet readers with a filter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import scalars


def save_clustered(df: DataFrame, path: str, order_by: Sequence[str], files: int, blooms: Mapping[str, int] | None = None,
                   row_group_bytes: int = 32 * 1024 * 1024, mode: str = "error") -> None:
    """Write ``df`` in ``files`` ranges of ``order_by``; a key with very many rows is cut by the columns behind it.

    ``blooms`` names further columns to look up, each with the number of distinct values to expect in a row group.
    """
    writer = (
        df.repartitionByRange(files, *order_by).sortWithinPartitions(*order_by)
        .write.mode(mode).option("parquet.block.size", row_group_bytes)
    )
    for column, distinct in (blooms or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    writer.parquet(path)


def look_up(df: DataFrame, column: str, value, moment: str | None = None, since=None, until=None) -> DataFrame:
    """Rows of one value, and of a span of time if one is given; the end is not part of it. All filters reach the scan."""
    found = df.where(F.col(column) == F.lit(value))
    if moment is not None and since is not None:
        found = found.where(F.col(moment) >= scalars.timestamp(since))
    if moment is not None and until is not None:
        found = found.where(F.col(moment) < scalars.timestamp(until))
    return found
