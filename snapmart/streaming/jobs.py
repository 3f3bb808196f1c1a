"""The polling loops as streaming queries.

A sink may see a micro-batch twice, for instance after a restart. Its name in the lake is made of the id of the
query, which stands in its checkpoint, and the number of the micro-batch, so it is the same when it runs again
and the work on the lake can be repeated. A stream that starts anew, even at the same path, has another id.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from snapmart.operators.audit import audit_headers, audit_rows
from snapmart.operators.changes import last_by_key, upsert
from snapmart.operators.latest import newest_per_group
from snapmart.plans.load import Feeds, load
from snapmart.schema import LANDED
from snapmart.session import ensure_checkpoint_dir
from snapmart.sources.lake import ADDED_IN, BATCH, Keyed, Lake

ONCE = {"availableNow": True}
# rows of a micro-batch, the lake, and the name of the batch
Work = Callable[[DataFrame, Lake, str], None]

# The column of a change stream that tells what happened to a key, and its values.
KIND = "change_kind"
PUT, DELETE = "put", "delete"


def stream_load(lake: Lake, landing: str, checkpoint: str, trigger: dict | None = None,
                files_per_batch: int | None = None, **load_options) -> StreamingQuery:
    """Load landing files (JSON lines of ``schema.LANDED``) as they arrive."""
    reader = lake.spark.readStream.schema(LANDED)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def work(rows: DataFrame, lake: Lake, batch: str) -> None:
        load(lake, Feeds.landed(_kept(rows)), batch, **load_options)

    return _start(reader.json(landing), into(lake, checkpoint, work), checkpoint, trigger)


def into(lake: Lake, checkpoint: str, work: Work) -> Callable[[DataFrame, int], None]:
    """``work`` for every micro-batch, with a name that stays the same when it runs again."""
    @cache
    def query_id() -> str:
        found = lake.spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
        return json.loads(found["value"])["id"]

    def run(rows: DataFrame, micro_batch: int) -> None:
        work(rows, lake, f"{query_id()}-{micro_batch:012d}")

    return run


def stream_latest(snapshots: DataFrame, key: str, order_by: Sequence[str], sink: Callable[[DataFrame, int], None],
                  checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Hand the changed newest rows of every micro-batch to ``sink``. The state holds one row per key."""
    return _start(newest_per_group(snapshots, [key], order_by), sink, checkpoint, trigger, "update")


def latest_into(table: str) -> Work:
    """Work for ``into``: puts changed rows into a keyed table."""
    def work(rows: DataFrame, lake: Lake, batch: str) -> None:
        changed = _kept(rows)
        spec = lake.tables[table]
        touched = lake.touched(table, changed)
        if touched:
            others = [c for c in spec.schema.fieldNames() if c != spec.key]
            lake.rewrite(table, upsert(lake.rows(table, touched), changed, [spec.key], others), touched)

    return work


def stream_sync(source: DataFrame, lake: Lake, checkpoint: str, table: str = "snapshot",
                trigger: dict | None = None) -> StreamingQuery:
    """Copy an append-only series; the checkpoint takes the place of the highest-key query."""
    return _start(source, into(lake, checkpoint, lambda rows, lake, batch: lake.add(table, rows, batch)), checkpoint, trigger)


def stream_changes(source: DataFrame, lake: Lake, checkpoint: str, table: str, order_by: Sequence[str],
                   tracked: Sequence[str], database: str = "snapmart", user: str = "loader", as_of=None,
                   collation: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Apply a stream of changes to a keyed table and log what each micro-batch did to its rows.

    ``source`` has the table's columns and KIND: ``put`` sets a row, ``delete`` takes it away. Of several changes
    to a key in one micro-batch the last by ``order_by`` counts. Each micro-batch meets the stored rows of its keys:
    whether a put inserts or updates, and what it changed, is found per key. A put that changes nothing, and a delete of
    a key that is not there, are not logged. Inserts, updates and deletes are one statement each. The log is
    written before the table, with the images that belong together; a micro-batch that runs again finds it and
    only repeats the change of the table.
    """
    spec = lake.tables[table]
    if not isinstance(spec, Keyed):
        raise ValueError(f"{table} is no keyed table")

    def work(rows: DataFrame, lake: Lake, batch: str) -> None:
        last = _kept(last_by_key(rows.select(*spec.schema.fieldNames(), KIND, *order_by), [spec.key], order_by))
        touched = lake.touched(table, last)
        if not touched:
            return
        stored = lake.rows(table, touched)
        columns = spec.schema.fieldNames()
        keys = last.select(spec.key)
        before = _kept(stored.join(keys, spec.key, "left_semi").select(*columns))
        after = last.where(F.col(KIND) == PUT).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])
        if lake.rows("audit").where((F.col(BATCH) == batch) & (F.col("table_name") == table)).isEmpty():
            touched_rows = audit_rows(before, after, spec.key, tracked, table, database, as_of, user, collation=collation,
                                      audit_id=lake.highest({"audit": "audit_id"}, batch)["audit"])
            kind = F.col("operation")
            number = F.when(kind == "INSERT", 1).when(kind == "UPDATE", 2).otherwise(3)
            logged = _kept(touched_rows.where((kind != "UPDATE") | F.col("changed_fields").isNotNull())
                           .withColumn("audit_id", F.col("audit_id") + number))
            lake.add("audit_row", logged, batch)
            lake.add("audit", audit_headers(logged, tracked), batch)
        others = stored.join(keys, spec.key, "left_anti")
        lake.rewrite(table, others.unionByName(after.withColumn(ADDED_IN, F.lit(batch))), touched)

    return _start(source, into(lake, checkpoint, work), checkpoint, trigger)


def stream_audit(source: DataFrame, lake: Lake, checkpoint: str, key: str, tracked: Sequence[str], table: str,
                 database: str = "snapmart", user: str = "loader", as_of=None,
                 trigger: dict | None = None) -> StreamingQuery:
    """Log every micro-batch of rows that are only ever inserted; ``stream_changes`` logs changes of all kinds."""
    def log(rows: DataFrame, lake: Lake, batch: str) -> None:
        number = lake.highest({"audit": "audit_id"}, batch)["audit"] + 1
        logged = _kept(audit_rows(rows.limit(0), rows, key, tracked, table, database, as_of, user, audit_id=number))
        lake.add("audit_row", logged, batch)
        lake.add("audit", audit_headers(logged, tracked), batch)

    return _start(source, into(lake, checkpoint, log), checkpoint, trigger)


def _kept(rows: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.checkpoint()


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _start(rows: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None,
           mode: str = "append") -> StreamingQuery:
    return (
        rows.writeStream.outputMode(mode).foreachBatch(work)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 minutes"})).start()
    )
