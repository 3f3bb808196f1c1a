"""Change from one reading to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PIECE = "__piece"
# Numbers that order a series are cut at multiples of this.
NUMBERS_PER_PIECE = 100_000


def piece_of(df: DataFrame, column: str) -> Column:
    """The piece of a series that a row belongs to: an hour, or a range of numbers. It grows with the order."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("hour", column)
    if isinstance(kind, T.NumericType):
        return F.floor(F.col(column) / NUMBERS_PER_PIECE)
    return F.col(column)


def deltas(df: DataFrame, key: str, order_by: Sequence[str], measures: Sequence[str],
           prefix: str = "delta_", piece: Column | None = None) -> DataFrame:
    """Every measure minus its value in the row before, 0 in a group's first row.

    ``order_by`` should end in a unique column. Every group is cut into pieces of
    its first order column, by default hours (see ``piece_of``), so that no task
    gets a whole group. Each piece takes a window of its own, and its first row gets
    the last values of the piece before, which come from an aggregate with one row
    per group and piece.
    """
    pieces = df.withColumn(_PIECE, piece_of(df, order_by[0]) if piece is None else piece)
    ends = ends_of(pieces, key, _PIECE, order_by, measures)
    return with_deltas(pieces, carried(ends, key, _PIECE), key, _PIECE, order_by, measures, prefix).drop(_PIECE)


def ends_of(pieces: DataFrame, key: str, piece: str, order_by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``key, piece, last``: the measures of the last row of every piece."""
    return pieces.groupBy(key, piece).agg(F.max_by(F.struct(*measures), F.struct(*order_by)).alias("last"))


def carried(ends: DataFrame, key: str, piece: str) -> DataFrame:
    """``__key, __at, __before``: for every piece the last measures of the piece before."""
    return ends.select(
        F.col(key).alias("__key"), F.col(piece).alias("__at"),
        F.lag("last").over(Window.partitionBy(key).orderBy(piece)).alias("__before"))


def with_deltas(pieces: DataFrame, before: DataFrame, key: str, piece: str, order_by: Sequence[str], measures: Sequence[str],
                prefix: str = "delta_") -> DataFrame:
    """Differences inside each piece; its first row is compared with what ``before`` carries into the piece."""
    same = F.col(key).eqNullSafe(F.col("__key")) & F.col(piece).eqNullSafe(F.col("__at"))
    window = Window.partitionBy(key, piece).orderBy(*order_by)
    first = F.row_number().over(window) == 1

    def previous(m: str) -> Column:
        at_start = F.when(F.col("__before").isNull(), F.col(m)).otherwise(F.col("__before")[m])
        return F.when(first, at_start).otherwise(F.lag(m).over(window))

    return (
        pieces.join(before, same, "left")
        .withColumns({prefix + m: F.col(m) - previous(m) for m in measures})
        .drop("__key", "__at", "__before")
    )


def history(df: DataFrame, key: str, value, order_by: Sequence[str], measures: Sequence[str],
            prefix: str = "delta_") -> DataFrame:
    """``deltas`` of one group, whose key is filtered in the scan."""
    return deltas(df.where(F.col(key) == F.lit(value)), key, order_by, measures, prefix)
