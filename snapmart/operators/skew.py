"""Work in order that is too big for one task.

``range_chunks`` cuts a frame into sorted pieces of about equal size whatever
the keys are, because the order it cuts by ends in a unique column. The pieces
are written to the shared checkpoint folder: range bounds come from a sample, so
a second evaluation could cut elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.session import ensure_checkpoint_dir, shuffle_partitions

CHUNK = "__chunk"
POSITION = "__position"

# monotonically_increasing_id: partition number above bit 33, row number below.
_ROW_BITS = 33


def range_chunks(df: DataFrame, order_by: Sequence[str], chunks: int | None = None) -> DataFrame:
    """``df`` cut by ``order_by``, with the columns CHUNK and POSITION added."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = chunks or shuffle_partitions(spark)
    row = F.monotonically_increasing_id()
    return (
        df.repartitionByRange(parts, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(CHUNK, F.shiftright(row, _ROW_BITS).cast("int"))
        .withColumn(POSITION, row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .checkpoint()
    )


def dense_ids(df: DataFrame, order_by: Sequence[str], id_col: str, start: int = 0,
              chunks: int | None = None) -> DataFrame:
    """Number the rows start+1, start+2, ... in the order of ``order_by``.

    A window over the whole frame would sort it in one task. Here every chunk
    is numbered by itself and shifted by the rows of the chunks before it; the
    only ungrouped window runs over one row per chunk.
    """
    chunked = range_chunks(df, order_by, chunks)
    sizes = chunked.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(CHUNK, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    return (
        # one row per chunk
        chunked.join(F.broadcast(offsets), CHUNK)
        .withColumn(id_col, F.lit(start) + F.col("__offset") + F.col(POSITION) + 1)
        .drop(CHUNK, POSITION, "__offset")
    )
