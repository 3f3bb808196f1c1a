"""What a copy of a table lacks, and the copy brought up to date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import scalars
from snapmart.operators.changes import ACTION, first_by_key, last_by_key, merge, upsert

MODES = ("FULL", "INCREMENTAL")


def check_mode(mode: str) -> str:
    wanted = mode.upper()
    if wanted not in MODES:
        raise ValueError(f"unknown mode {mode!r}, use one of {', '.join(MODES)}")
    return wanted


def max_key(df: DataFrame, key: str) -> DataFrame:
    """One row ``max_key``, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("max_key"))


def highest(df: DataFrame, key: str) -> int:
    return max_key(df, key).first()["max_key"]


def gap(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows behind the target's highest key.

    The highest key goes into the filter as a constant, so the scan can skip
    row groups by their statistics.
    """
    return source.where(F.col(key) > highest(target, key))


def append_gap(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows an append-only copy lacks; nothing is read if the highest keys agree."""
    copied, present = highest(target, key), highest(source, key)
    if copied >= present:
        return source.limit(0)
    return source.where(F.col(key) > copied).sortWithinPartitions(key)


def insert_ignore(source: DataFrame, target: DataFrame, watermark: str, keys: Sequence[str],
                  unique: str | None = None) -> DataFrame:
    """New rows for the target: behind the watermark, one per key, no unique value twice.

    Rows behind the watermark cannot be in the target, so only ``unique`` needs
    a comparison with it.
    """
    new = first_by_key(gap(source, target, watermark), keys, [watermark])
    if unique is not None:
        new = first_by_key(new, [unique], [watermark]).join(target.select(unique), unique, "left_anti")
    return new


def newest_behind(source: DataFrame, target: DataFrame, watermark: str, key: str) -> DataFrame:
    """Rows behind the target's highest ``watermark``, of each ``key`` the one with the highest; none without a key."""
    return last_by_key(gap(source, target, watermark).where(F.col(key).isNotNull()), [key], [watermark])


def upsert_gap(source: DataFrame, target: DataFrame, watermark: str, update_cols: Sequence[str],
               unique: str | None = None) -> DataFrame:
    """The target with the rows behind its highest ``watermark`` inserted, or updated on a clash.

    A row whose ``unique`` value the target has already updates that row's ``update_cols`` and keeps its
    watermark; the others are inserted. Without ``unique`` rows are told apart by the watermark, which cannot clash.
    """
    new = newest_behind(source, target, watermark, unique or watermark)
    return merge(target, new.select(*target.columns), [unique or watermark], update_cols).drop(ACTION)


def recent_changes(source: DataFrame, target: DataFrame, natural_key: str, changed_at: str, as_of=None,
                   hours: int = 24) -> DataFrame:
    """Source rows to send: unknown natural keys, and known ones changed lately. ``is_new`` tells which.

    One join finds both, so the source is worked out once. A row without a key is not known.
    """
    known = target.select(natural_key).distinct().withColumn("__known", F.lit(True))
    found = source.join(known, natural_key, "left").withColumn("is_new", F.col("__known").isNull()).drop("__known")
    lately = scalars.is_recent(changed_at, scalars.timestamp(as_of), hours)
    return found.where(F.col("is_new") | lately)


def apply_recent_changes(source: DataFrame, target: DataFrame, natural_key: str, changed_at: str, as_of=None,
                         hours: int = 24) -> DataFrame:
    """The target with new rows added and lately changed rows replaced."""
    sent = recent_changes(source, target, natural_key, changed_at, as_of, hours).select(*target.columns)
    others = [c for c in target.columns if c != natural_key]
    return upsert(target, sent, [natural_key], others)
