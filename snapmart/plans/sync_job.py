"""Bringing a whole lake up to date with its source tables."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.operators import changes, sync
from snapmart.sources.lake import ADDED_IN, BUCKET, Keyed, Lake
from snapmart.sources.tables import counted, read_table, write_jdbc


@dataclass(frozen=True)
class Synced:
    """How a table is copied: its watermark, the columns that name a row, and what happens to a new row whose
    ``unique`` value the copy has already: it is ignored, or it updates that row."""

    table: str
    watermark: str
    keys: tuple[str, ...]
    unique: str | None = None
    updates: bool = False


# Parents first.
ORDER = (
    Synced("category", "category_id", ("category_id",), "category_name"),
    Synced("entity", "entity_id", ("entity_id",), "external_id", updates=True),
    Synced("bridge", "entity_id", ("entity_id", "category_id")),
    Synced("rating", "rating_id", ("rating_id",), "entity_id", updates=True),
    Synced("snapshot", "snapshot_id", ("snapshot_id",)),
)
WAYS = ("max_key", "changed_since")


def sync_tables(source: Mapping[str, DataFrame], lake: Lake, batch: str, mode: str = "INCREMENTAL",
                by: str = "max_key", as_of=None, hours: int = 24, natural_key: str = "external_id",
                changed_at: str = "updated_at", order: Sequence[Synced] = ORDER) -> DataFrame:
    """Copy what the lake lacks and return one row of counts.

    FULL replaces everything. INCREMENTAL by ``max_key`` sends the rows behind the highest key of each table. A
    row whose unique value is there already is ignored or updates what is there, as ``order`` says; an update
    keeps the key of the copy. By ``changed_since`` entities are sent if their natural key is unknown or they
    changed lately, and the other tables as before. ``order`` names the tables, parents first. The same batch run
    again sends what is still missing.
    """
    mode = sync.check_mode(mode)
    if by not in WAYS:
        raise ValueError(f"unknown way {by!r}, use one of {', '.join(WAYS)}")
    started, sent = time.monotonic(), {}
    for s in order:
        if mode == "FULL":
            lake.replace(s.table, source[s.table], batch)
            sent[s.table] = lake.read(s.table).count(), 0
        else:
            # without the rows of this batch, so that one that died half-way starts where it started
            copy = lake.earlier(s.table, batch).select(*lake.tables[s.table].schema.fieldNames())
            if s.table == "entity" and by == "changed_since":
                rows = sync.recent_changes(source[s.table], copy, natural_key, changed_at, as_of, hours).drop("is_new")
                sent[s.table] = _put(lake, s.table, batch, rows, [natural_key])
            elif s.updates:
                rows = sync.newest_behind(source[s.table], copy, s.watermark, s.unique)
                sent[s.table] = _put(lake, s.table, batch, rows, [s.unique], keep=[s.watermark])
            else:
                rows = (sync.append_gap(source[s.table], copy, s.watermark) if s.table == "snapshot"
                        else sync.insert_ignore(source[s.table], copy, s.watermark, s.keys, s.unique))
                sent[s.table] = (_put(lake, s.table, batch, rows) if isinstance(lake.tables[s.table], Keyed)
                                 else _add(lake, s.table, batch, rows))
    return _result(lake.spark, order, mode, sent, started)


def sync_digests(source: Lake, copy: Lake, tables: Sequence[str]) -> DataFrame:
    """Make the keyed tables of ``copy`` equal to those of ``source`` by their digests; one row of counts per table.

    Both lakes must have the same buckets. Only buckets whose checksums differ are read, from the source, and
    written anew in the copy. So rows that were changed without a trace, that were deleted, or that the copy
    has on its own are put right too, and what is read grows with what differs.
    """
    results = []
    for table in tables:
        spec, other = source.tables[table], copy.tables[table]
        if (spec.key, spec.buckets) != (other.key, other.buckets):
            raise ValueError(f"{table} has not the same buckets on both sides")
        unequal = differing_buckets(source.digests(table), copy.digests(table))
        if unequal:
            copy.rewrite(table, source.rows(table, unequal).drop(ADDED_IN), unequal)
        results.append((table, spec.buckets, len(unequal)))
    return source.spark.createDataFrame(results, "table_name string, buckets long, unequal_buckets long")


def differing_buckets(one: DataFrame, other: DataFrame) -> list[int]:
    """Buckets that are not the same on both sides: at most the number of buckets. No digest is that of no rows."""
    right = other.select(F.col(BUCKET).alias("__bucket"), F.col("rows").alias("__rows"), F.col("checksum").alias("__checksum"))
    joined = one.join(right, F.col(BUCKET) == F.col("__bucket"), "full_outer")
    zero = F.lit(0)
    same = (F.coalesce("rows", zero) == F.coalesce("__rows", zero)) & (F.coalesce("checksum", zero) == F.coalesce("__checksum", zero))
    return sorted(r[0] for r in joined.where(~same).select(F.coalesce(BUCKET, "__bucket")).collect())


def _add(lake: Lake, table: str, batch: str, rows: DataFrame) -> tuple[int, int]:
    watched, seen = counted(rows, table)
    lake.add(table, watched, batch)
    return seen.get["rows"], 0


def _put(lake: Lake, table: str, batch: str, rows: DataFrame, keys: Sequence[str] = (),
         keep: Sequence[str] = ()) -> tuple[int, int]:
    """Insert or update, and how many of each; only the buckets that receive rows are read and written.

    Without ``keys`` no row can be there, as behind a watermark, and the rows are put to the stored ones without
    a look-up. ``keep`` names columns that an update leaves as they are.
    """
    sent, spec = lake.keep("sync_sent", rows), lake.tables[table]
    touched = lake.touched(table, sent)
    if not touched:
        return 0, 0
    stored = lake.earlier(table, batch, touched)
    if keys:
        others = [c for c in spec.schema.fieldNames() if c not in (*keys, *keep)]
        merged = changes.merge(stored, sent, keys, others)
        inserted = F.col(changes.ACTION) == changes.INSERT
        done = merged.withColumn(ADDED_IN, F.when(inserted, F.lit(batch)).otherwise(F.col(ADDED_IN))).drop(changes.ACTION)
    else:
        done = stored.unionByName(sent.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields], F.lit(batch).alias(ADDED_IN)))
    lake.rewrite(table, done, touched)
    all_sent = sent.count()
    if not keys:
        return all_sent, 0
    # the mark of the batch tells what was inserted; a row without the table's key updates nothing and is not seen again
    named = sent.where(F.col(spec.key).isNotNull()).count()
    updated = named - lake.rows(table, touched).where(F.col(ADDED_IN) == batch).count()
    return all_sent - updated, updated


def sync_jdbc(source: Mapping[str, DataFrame], targets: Mapping[str, Mapping[str, str]], mode: str = "INCREMENTAL",
              order: Sequence[Synced] = ORDER) -> DataFrame:
    """Copy tables to a database; ``targets`` holds the JDBC options of each table.

    FULL empties the tables, children first, and reloads them, parents first.
    INCREMENTAL asks the database for its highest key and appends what is behind
    it, but for rows whose unique value is there already; Spark's writer knows no update. Every partition writes
    in batches of its own.
    """
    mode = sync.check_mode(mode)
    spark = next(iter(source.values())).sparkSession
    started, sent = time.monotonic(), {}
    if mode == "FULL":
        for s in reversed(order):
            write_jdbc(source[s.table].limit(0), targets[s.table], "overwrite")
    for s in order:
        rows = source[s.table]
        if mode == "INCREMENTAL":
            rows = sync.first_by_key(rows.where(F.col(s.watermark) > jdbc_max_key(spark, targets[s.table], s.watermark)),
                                     s.keys, [s.watermark])
            if s.unique:
                there = read_table(spark, targets[s.table], [s.unique])
                rows = sync.first_by_key(rows, [s.unique], [s.watermark]).join(there, s.unique, "left_anti").select(*rows.columns)
        sent[s.table] = write_jdbc(rows, targets[s.table]), 0
    return _result(spark, order, mode, sent, started)


def jdbc_max_key(spark: SparkSession, options: Mapping[str, str], key: str) -> int:
    """The highest key of a database table, worked out by the database; 0 if it is empty."""
    asked = {k: v for k, v in options.items() if k != "dbtable"}
    asked["query"] = f"SELECT COALESCE(MAX({key}), 0) AS max_key FROM {options['dbtable']}"
    return int(read_table(spark, asked).first()[0])


def _result(spark: SparkSession, order: Sequence[Synced], mode: str, sent: Mapping[str, tuple[int, int]],
            started: float) -> DataFrame:
    """Rows sent of each table, and how many of all were inserted and updated."""
    names = [s.table for s in order]
    counts = [sent.get(n, (0, 0)) for n in names]
    inserted, updated = (sum(c[i] for c in counts) for i in (0, 1))
    row = (mode, *map(sum, counts), inserted + updated, inserted, updated, int((time.monotonic() - started) * 1000),
           datetime.now(timezone.utc).replace(tzinfo=None))
    columns = ", ".join(f"{n}_rows long" for n in names)
    return spark.createDataFrame([row], (
        f"mode string, {columns}, total_rows long, inserted_rows long, updated_rows long, duration_ms long, "
        "finished_at timestamp_ntz"))
