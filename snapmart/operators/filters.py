"""Row filters by parameter. All but those under a collation are pushed to the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import scalars


def filter_between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Both ends belong to the range."""
    return df.where(F.col(column).between(F.lit(low), F.lit(high)))


def filter_at_least(df: DataFrame, column: str, low) -> DataFrame:
    return df.where(F.col(column) >= F.lit(low))


def filter_equal(df: DataFrame, column: str, value: str, collation: str | None = None) -> DataFrame:
    """Text equal to ``value``; with a collation such as es_CI_AI_RTRIM without regard to case, accents and trailing blanks."""
    return df.where(scalars.same_text(column, value, collation))


def filter_in(df: DataFrame, column: str, values: Sequence[str], collation: str | None = None) -> DataFrame:
    return df.where(scalars.one_of(column, values, collation))


def filter_prefix(df: DataFrame, column: str, prefix: str, collation: str | None = None) -> DataFrame:
    return df.where(scalars.begins_with(column, prefix, collation))


def filter_above(df: DataFrame, column: str, low) -> DataFrame:
    return df.where(F.col(column) > F.lit(low))


def after_key(df: DataFrame, key: str, highest_seen) -> DataFrame:
    """Rows behind a watermark, sorted inside each partition for writing."""
    return filter_above(df, key, highest_seen).sortWithinPartitions(key)


def changed_since(df: DataFrame, changed_at: str, as_of, hours: int = 24) -> DataFrame:
    return df.where(scalars.is_recent(changed_at, scalars.timestamp(as_of), hours))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Column defaults: a null becomes the default, in the column's own type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: F.coalesce(F.col(c), (v if not isinstance(v, (str, int, float)) else F.lit(v)).cast(types[c]))
        for c, v in defaults.items()
    })
