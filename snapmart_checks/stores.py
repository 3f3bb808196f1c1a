"""Checks of whole jobs: load, sync, streams and the daily report. Each writes to a new folder."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.driver_tables import COLUMNS, driver_table, role, tables
from snapmart.plans import catalog, reports
from snapmart.plans.load import POLL, Feeds, load_batch
from snapmart.plans.sync_job import sync_tables
from snapmart.roles import Tables
from snapmart.schema import SNAPSHOT
from snapmart.session import ensure_checkpoint_dir
from snapmart.sources.lake import Keyed, Lake, layout
from snapmart.sources.tables import append_snapshots, overwrite_tables
from snapmart.streaming import jobs
from snapmart_checks import feeds as raw
from snapmart_checks.base import AS_OF, REGISTRY, REPORT_DAY, ROLE_COLUMNS, check, json_sql, row_text, row_text_sql
from snapmart_checks.operators import MEASURES
from snapmart_checks.plans import _with_latest

BUCKETS = 8
POLLED = "2024-02-01 06:00:00"


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/snapmart-{uuid.uuid4().hex}"


def _raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    at = F.lit(POLLED).cast("timestamp_ntz")
    frames = {"ranking": raw.raw_item_ranking(spark, sf_dir).withColumn("external_id", F.lit(None).cast("long")),
              "details": raw.raw_details(spark, sf_dir), "ratings": raw.raw_ratings(spark, sf_dir),
              "current": raw.raw_current(spark, sf_dir)}
    return {n: f.select(at.alias(POLL), "external_id", "body") for n, f in frames.items()}


def _stored(lake: Lake) -> Tables:
    return Tables(*[lake.read(t) for t in ("entity", "category", "bridge", "snapshot", "rating")])


def _loaded_view(lake: Lake) -> DataFrame:
    """Everything a load wrote, one row per entity."""
    t = _stored(lake)
    readings = t.snapshot.select("entity_id", "snapshot_id", "current_count", "total_ratings", "recorded_at")
    return catalog.top_entities(t).join(readings, "entity_id").select(
        "entity_id", "external_id", "name", "maker", "publisher", "price", "highest_peak", "categories",
        "positive_pct", "label", "snapshot_id", "current_count", "total_ratings", "recorded_at")


_LOADED_SQL = f"""
    SELECT row_number() OVER (ORDER BY d.external_id) AS entity_id, d.external_id, d.name, d.maker, d.publisher,
           d.price, greatest(p.p_size * 95, coalesce(c.live_count, p.p_size * 90)) AS highest_peak,
           CASE WHEN d.publisher < 'Indie' THEN concat(d.publisher, ', Indie')
                ELSE concat('Indie, ', d.publisher) END AS categories,
           CAST(r.positive_pct AS DOUBLE) AS positive_pct, r.label,
           row_number() OVER (ORDER BY d.external_id) AS snapshot_id,
           coalesce(c.live_count, p.p_size * 90) AS current_count,
           coalesce(r.positive + r.negative, 0) AS total_ratings, TIMESTAMP '{POLLED}' AS recorded_at
    FROM part p
    JOIN ({raw._DETAILS_SQL}) d ON d.external_id = p.p_partkey * 10 + 7
    LEFT JOIN (SELECT *, entity_id * 10 + 7 AS external_id FROM rating WHERE positive_pct > 20) r
           ON r.external_id = d.external_id
    LEFT JOIN ({raw._CURRENT_SQL}) c ON c.external_id = d.external_id"""


@check("load_batch", _LOADED_SQL, ("entity", "rating"))
def _load_batch(spark, sf_dir):
    lake = Lake(spark, new_folder(spark), layout(BUCKETS))
    load_batch(lake, Feeds(**_raw_feeds(spark, sf_dir)), 0, AS_OF)
    return _loaded_view(lake)


@check("stream_load", _LOADED_SQL, ("entity", "rating"))
def _stream_load(spark, sf_dir):
    folder = new_folder(spark)
    landing = f"{folder}/landing"
    rows = [f.withColumn("feed", F.lit(n)) for n, f in _raw_feeds(spark, sf_dir).items()]
    reduce(DataFrame.unionByName, rows).write.json(landing)
    lake = Lake(spark, f"{folder}/lake", layout(BUCKETS))
    jobs.stream_load(lake, landing, f"{folder}/progress", jobs.ONCE, as_of=AS_OF).awaitTermination()
    return _loaded_view(lake)


@check("load_tally", """
    SELECT CAST(0 AS BIGINT) AS batch, count(d.external_id) AS loaded, count(*) - count(d.external_id) AS skipped,
           CAST(0 AS BIGINT) AS rejected, CAST(0 AS BIGINT) AS entities_updated, count(d.external_id) AS entities_inserted,
           count(d.external_id) AS snapshots_inserted,
           (SELECT count(DISTINCT publisher) + 1 FROM entity WHERE maker IS NULL OR maker <> 'Brand#17') AS categories_inserted
    FROM part p LEFT JOIN (SELECT external_id FROM entity WHERE maker IS NULL OR maker <> 'Brand#17') d
      ON d.external_id = p.p_partkey * 10 + 7""", ("entity",))
def _load_tally(spark, sf_dir):
    lake = Lake(spark, new_folder(spark), layout(BUCKETS))
    return load_batch(lake, Feeds(**_raw_feeds(spark, sf_dir)), 0, AS_OF)


class _Dying(Lake):
    """A lake whose writer dies before it writes one of the tables."""

    dies_at = ""

    def _write(self, table, rows, folders):
        if table == self.dies_at:
            raise InterruptedError(table)
        super()._write(table, rows, folders)


def _loaded_twice(spark, sf_dir, dies_at: str) -> Lake:
    """A first attempt, a day earlier, dies before it writes a table; then the batch runs again."""
    lake = _Dying(spark, new_folder(spark), layout(BUCKETS))
    raw = Feeds(**_raw_feeds(spark, sf_dir))
    lake.dies_at = dies_at
    try:
        load_batch(lake, raw, 0, "2001-11-03 00:00:00")
    except InterruptedError:
        lake.dies_at = ""
    load_batch(lake, raw, 0, AS_OF)
    return lake


@check("load_retry", _LOADED_SQL, ("entity", "rating"))
def _load_retry(spark, sf_dir):
    return _loaded_view(_loaded_twice(spark, sf_dir, "rating"))


@check("load_retry_audit", f"""
    SELECT 'entity' AS table_name, CAST(entity_id AS VARCHAR) AS row_key, 'INSERT' AS operation, 'loader' AS user_name,
           TIMESTAMP '{AS_OF}' AS logged_at, CAST(1 AS BIGINT) AS audit_id FROM ({_LOADED_SQL}) l
    UNION ALL
    SELECT 'snapshot', CAST(snapshot_id AS VARCHAR), 'INSERT', 'loader', TIMESTAMP '{AS_OF}', 3 FROM ({_LOADED_SQL}) l""",
       ("entity", "rating"))
def _load_retry_audit(spark, sf_dir):
    rows = _loaded_twice(spark, sf_dir, "audit").read("audit_row")
    return rows.select("table_name", "row_key", "operation", "user_name", "logged_at", "audit_id")


@check("load_after_sync", f"""
    SELECT snapshot_id, entity_id, external_id FROM (
        WITH l AS ({_LOADED_SQL}), n AS (SELECT count(*) // 2 AS half FROM l),
             f AS (SELECT l.*, publisher = 'ECONOMY' OR entity_id <= half AS known FROM l, n),
             m AS (SELECT max(snapshot_id) AS s, max(entity_id) AS e FROM f WHERE known)
        SELECT snapshot_id, entity_id, external_id FROM f WHERE known
        UNION ALL
        SELECT s + row_number() OVER (ORDER BY id), id, external_id
        FROM (SELECT s, external_id, CASE WHEN known THEN entity_id
                     ELSE e + row_number() OVER (PARTITION BY known ORDER BY external_id) END AS id FROM f, m) g) v""",
       ("entity", "rating"))
def _load_after_sync(spark, sf_dir):
    """Part of a loaded lake is copied by a sync; a load into the copy numbers on behind it."""
    raw = Feeds(**_raw_feeds(spark, sf_dir))
    first = Lake(spark, new_folder(spark), layout(BUCKETS))
    load_batch(first, raw, 0, AS_OF)
    half = first.read("entity").count() // 2
    some = first.read("entity").where((F.col("publisher") == "ECONOMY") | (F.col("entity_id") <= half))
    known = some.select("entity_id")
    source = {"entity": some, "category": first.read("category")}
    source |= {t: first.read(t).join(known, "entity_id", "left_semi") for t in ("bridge", "rating", "snapshot")}
    copy = Lake(spark, new_folder(spark), layout(BUCKETS))
    sync_tables(source, copy, "full", "FULL")
    load_batch(copy, raw, 1, AS_OF)
    return copy.read("snapshot").join(copy.read("entity"), "entity_id").select("snapshot_id", "entity_id", "external_id")


_BAD = {5: "details_key_readable", 6: "price_readable", 7: "details_readable", 8: "category_name_not_blank"}


@check("load_with_bad_documents", f"""
    SELECT external_id, CASE p_size {' '.join(f"WHEN {n} THEN '{reason}'" for n, reason in _BAD.items())} ELSE 'loaded' END AS state
    FROM part p JOIN (SELECT external_id, maker FROM entity) e ON e.external_id = p.p_partkey * 10 + 7
    WHERE maker IS NULL OR maker <> 'Brand#17' OR p_size IN (5, 7)""", ("entity",))
def _load_with_bad_documents(spark, sf_dir):
    raw = _raw_feeds(spark, sf_dir)
    sizes = driver_table(spark, sf_dir, "part").select((F.col("p_partkey") * 10 + 7).alias("external_id"), "p_size")
    body, size = F.col("body"), F.col("p_size")
    broken = (
        F.when(size == 5, F.regexp_replace(body, r'^\{"', '{"x'))
        .when(size == 6, F.regexp_replace(body, '"release_date"', '"price_overview":{"final":10000000000000},"release_date"'))
        .when(size == 7, F.lit("no document"))
        .when(size == 8, F.replace(body, F.lit('"Indie"'), F.lit('" "'))).otherwise(body)
    )
    raw["details"] = raw["details"].join(sizes, "external_id").withColumn("body", broken).drop("p_size")
    lake = Lake(spark, new_folder(spark), layout(BUCKETS))
    load_batch(lake, Feeds(**raw), 0, AS_OF)
    loaded = lake.read("entity").select("external_id", F.lit("loaded").alias("state"))
    return loaded.unionByName(lake.read("quarantine").select("external_id", F.col("reasons").alias("state")))


_SYNCED = ("category", "entity", "bridge", "rating", "snapshot")
_STAMPED = {"created_at": f"coalesce(created_at, TIMESTAMP '{AS_OF}') AS created_at",
            "updated_at": f"coalesce(updated_at, TIMESTAMP '{AS_OF}') AS updated_at"}


def _source_and_copy(spark, sf_dir):
    """The roles as a source, and a lake with an older copy of them."""
    now = F.lit(AS_OF).cast("timestamp_ntz")
    source = {t: role(spark, sf_dir, t) for t in _SYNCED}
    source["entity"] = source["entity"].withColumns({c: F.coalesce(c, now) for c in ("created_at", "updated_at")})
    # the copy ends where the older copy of the readings and entities end
    known = role(spark, sf_dir, "target_entity").agg(F.max("entity_id")).first()[0]
    older = {t: df.where(F.col("entity_id") <= known) if "entity_id" in df.columns else df.where("category_id < 0")
             for t, df in source.items()}
    older["entity"] = older["entity"].withColumn("name", F.upper("name"))
    older["snapshot"] = role(spark, sf_dir, "target_snapshot")
    lake = Lake(spark, new_folder(spark), layout(BUCKETS))
    sync_tables(older, lake, "older", "FULL")
    return source, lake


def _synced_sql(name: str) -> str:
    return " UNION ALL ".join(
        row_text_sql(t, t, [_STAMPED.get(c, name if c == "name" else c) for c in ROLE_COLUMNS[t]]) for t in _SYNCED)


def _synced(lake: Lake) -> DataFrame:
    return reduce(DataFrame.unionByName, [row_text(lake.read(t).select(*ROLE_COLUMNS[t]), t) for t in _SYNCED])


_OLD = "entity_id <= (SELECT max(entity_id) FROM target_entity)"
_LATELY = f"coalesce(updated_at, TIMESTAMP '{AS_OF}') >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR"


@check("sync_store", _synced_sql(f"CASE WHEN {_OLD} THEN upper(name) ELSE name END AS name"), (*_SYNCED, "target_entity"))
def _sync_store(spark, sf_dir):
    """An older copy, completed step by step; changes to old keys are not seen."""
    source, lake = _source_and_copy(spark, sf_dir)
    sync_tables(source, lake, "newer", "INCREMENTAL")
    return _synced(lake)


@check("sync_store_changed", _synced_sql(f"CASE WHEN {_OLD} AND NOT {_LATELY} THEN upper(name) ELSE name END AS name"),
       (*_SYNCED, "target_entity"))
def _sync_store_changed(spark, sf_dir):
    source, lake = _source_and_copy(spark, sf_dir)
    sync_tables(source, lake, "newer", by="changed_since", as_of=AS_OF)
    return _synced(lake)


def _behind(table: str, target: str, key: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {key} > (SELECT max({key}) FROM {target}))"


_CHANGED = f"(SELECT count(*) FROM entity WHERE {_OLD} AND {_LATELY})"
_SENT = {"category": "(SELECT count(*) FROM category WHERE category_id >= 0)", "bridge": _behind("bridge", "target_entity", "entity_id"),
         "entity": f"({_behind('entity', 'target_entity', 'entity_id')} + {_CHANGED})",
         "rating": "(SELECT count(*) FROM rating WHERE entity_id > (SELECT max(entity_id) FROM target_entity))",
         "snapshot": _behind("snapshot", "target_snapshot", "snapshot_id")}


@check("sync_result", f"""
    SELECT 'INCREMENTAL' AS mode, {', '.join(f'{q} AS {t}_rows' for t, q in _SENT.items())},
           {' + '.join(_SENT.values())} AS total_rows, {' + '.join(_SENT.values())} - {_CHANGED} AS inserted_rows,
           {_CHANGED} AS updated_rows""", (*_SYNCED, "target_entity", "target_snapshot"))
def _sync_result(spark, sf_dir):
    source, lake = _source_and_copy(spark, sf_dir)
    done = sync_tables(source, lake, "newer", by="changed_since", as_of=AS_OF)
    return done.drop("duration_ms", "finished_at")


_AGAIN = 1_000_000_000


def _clashing(source: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The source with new rows, behind all others, whose unique value an older row has."""
    def again(table: str, key: str, rows: str, **changed):
        old = source[table].where(rows)
        return source[table].unionByName(old.withColumns({key: F.col(key) + _AGAIN, **changed}))

    return source | {
        "category": again("category", "category_id", "category_id % 3 = 0"),
        "entity": again("entity", "entity_id", "entity_id % 4 = 0", name=F.concat("name", F.lit(" again"))),
        "rating": again("rating", "rating_id", "rating_id % 5 = 0", positive=F.col("positive") + 1),
    }


@check("sync_clashes", f"""
    {row_text_sql('category', 'category', ROLE_COLUMNS['category'])}
    UNION ALL
    {row_text_sql("(SELECT e.* REPLACE (CASE WHEN entity_id % 4 = 0 THEN concat(name, ' again') WHEN " + _OLD
                  + " THEN upper(name) ELSE name END AS name, CASE WHEN entity_id % 4 = 0 AND NOT " + _OLD
                  + f" THEN entity_id + {_AGAIN} ELSE entity_id END AS entity_id) FROM entity e) v", 'entity',
                  [_STAMPED.get(c, c) for c in ROLE_COLUMNS['entity']])}
    UNION ALL
    {row_text_sql("(SELECT r.* REPLACE (CASE WHEN rating_id % 5 = 0 THEN positive + 1 ELSE positive END AS positive, "
                  "CASE WHEN rating_id % 5 = 0 AND NOT " + _OLD + f" THEN rating_id + {_AGAIN} ELSE rating_id END AS rating_id) FROM rating r) w",
                  'rating', ROLE_COLUMNS['rating'])}""", (*_SYNCED, "target_entity"))
def _sync_clashes(spark, sf_dir):
    """New, clashing and old keys at once: an entity or rating that clashes updates the row that is there and keeps
    its key; a category that clashes is ignored."""
    source, lake = _source_and_copy(spark, sf_dir)
    sync_tables(_clashing(source), lake, "newer")
    return reduce(DataFrame.unionByName, [row_text(lake.read(t).select(*ROLE_COLUMNS[t]), t) for t in ("category", "entity", "rating")])


@check("tables_reloaded", " UNION ALL ".join(row_text_sql(t, t, ROLE_COLUMNS[t]) for t in ("category", "bridge")),
       ("category", "bridge"))
def _tables_reloaded(spark, sf_dir):
    folder, frames = new_folder(spark), {t: role(spark, sf_dir, t) for t in ("category", "bridge")}
    targets = {t: f"{folder}/{t}" for t in frames}
    overwrite_tables({t: df.limit(3) for t, df in frames.items()}, targets, list(frames))
    sent = overwrite_tables(frames, targets, list(frames))
    found = {t: spark.read.parquet(p) for t, p in targets.items()}
    if sent != {t: df.count() for t, df in found.items()}:
        raise ValueError(f"rows reported {sent} are not those written")
    return reduce(DataFrame.unionByName, [row_text(df, t) for t, df in found.items()])


@check("snapshots_appended", """
    SELECT snapshot_id, entity_id, current_count, greatest(peak_count, current_count) AS peak_count, total_ratings, recorded_at,
           CAST(CAST(recorded_at AS DATE) AS VARCHAR) AS recorded_date FROM snapshot""", ("snapshot",))
def _snapshots_appended(spark, sf_dir):
    path, rows = new_folder(spark), role(spark, sf_dir, "snapshot")
    early = F.col("recorded_at") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    append_snapshots(rows.where(early), path)
    append_snapshots(rows.where(~early), path)
    return spark.read.parquet(path)


def _reading_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of readings."""
    # a pattern, since a stream source takes no single file
    events = jobs.file_stream(spark, f"{sf_dir}/events.parquet*", COLUMNS["events"])
    count = F.round(F.col("value") * 100).cast("long")
    return events.select(
        F.col("event_id").alias("snapshot_id"), F.col("user_id").alias("entity_id"), count.alias("current_count"),
        (count + F.when(F.col("event_type") == "view", 0).otherwise(250)).alias("peak_count"),
        (F.col("event_id") * 3).alias("total_ratings"), F.col("ts").alias("recorded_at"))


@check("stream_latest", """
    SELECT snapshot_id, entity_id, current_count, peak_count, total_ratings, recorded_at
    FROM (SELECT s.*, row_number() OVER (PARTITION BY entity_id ORDER BY recorded_at DESC, snapshot_id DESC) AS n
          FROM snapshot s) v WHERE n = 1""", ("snapshot",))
def _stream_latest(spark, sf_dir):
    folder = new_folder(spark)
    lake = Lake(spark, f"{folder}/lake", {"latest": Keyed(SNAPSHOT, "entity_id", BUCKETS)})
    progress = f"{folder}/progress"
    jobs.stream_latest(
        _reading_stream(spark, sf_dir), "entity_id", ["recorded_at", "snapshot_id"],
        jobs.into(lake, progress, jobs.latest_into("latest")),
        progress, jobs.ONCE).awaitTermination()
    return lake.read("latest")


@check("stream_sync", "SELECT * FROM snapshot", ("snapshot",))
def _stream_sync(spark, sf_dir):
    folder = new_folder(spark)
    lake = Lake(spark, f"{folder}/lake", layout(BUCKETS))
    jobs.stream_sync(_reading_stream(spark, sf_dir), lake, f"{folder}/progress", trigger=jobs.ONCE).awaitTermination()
    return lake.read("snapshot").drop("recorded_date")


_READING_JSON = {"snapshot_id": "n", "entity_id": "n", "current_count": "n", "peak_count": "n", "total_ratings": "n",
                 "recorded_at": "t"}


@check("stream_audit", f"""
    SELECT CAST(snapshot_id AS VARCHAR) AS row_key, 'INSERT' AS operation, CAST(NULL AS VARCHAR) AS before_row,
           {json_sql(_READING_JSON)} AS after_row, CAST(NULL AS VARCHAR) AS changed_fields, CAST(1 AS BIGINT) AS audit_id
    FROM (SELECT * REPLACE (CASE WHEN microsecond(recorded_at) % 1000000 = 0 THEN strftime(recorded_at, '%Y-%m-%dT%H:%M:%S')
                                 ELSE strftime(recorded_at, '%Y-%m-%dT%H:%M:%S.%f') END AS recorded_at) FROM snapshot) s""",
       ("snapshot",))
def _stream_audit(spark, sf_dir):
    folder = new_folder(spark)
    lake = Lake(spark, f"{folder}/lake", layout(BUCKETS))
    jobs.stream_audit(_reading_stream(spark, sf_dir), lake, f"{folder}/progress", "snapshot_id", MEASURES, "snapshot",
                      trigger=jobs.ONCE).awaitTermination()
    return lake.read("audit_row").select("row_key", "operation", "before_row", "after_row", "changed_fields", "audit_id")


# Orders as a table that changes: first some are put and changed, then some are taken away and others put back.
_ORDER = T.StructType([T.StructField("order_id", T.LongType(), False), T.StructField("status", T.StringType()),
                       T.StructField("price", T.DecimalType(14, 2)), T.StructField("note", T.StringType())])
_ORDER_SQL = """SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(14,2)) AS price,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS note FROM {orders}"""
_ORDER_FIELDS = ["status", "price", "note"]


def _order_changes(orders: DataFrame, first: bool) -> DataFrame:
    """Two rounds of changes; in a round some keys change twice, and only the later change counts."""
    step = F.col("order_id") % 6
    if first:
        dearer = F.when(step == 1, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(14,2)")
        rows = orders.where(step.isin(0, 1, 3)).withColumn("price", dearer)
        rows = rows.withColumns({"note": F.when(step == 1, F.lit(None)).otherwise(F.col("note")), jobs.KIND: F.lit(jobs.PUT)})
        earlier = rows.where("order_id % 4 = 0").withColumns({"status": F.lit("?"), jobs.KIND: F.lit(jobs.DELETE), "seq": F.lit(0)})
        return rows.withColumn("seq", F.lit(1)).unionByName(earlier)
    gone = orders.where(step.isin(0, 2, 5) & (F.col("order_id") % 5 == 0))
    back = orders.where(step == 1)
    return gone.withColumn(jobs.KIND, F.lit(jobs.DELETE)).unionByName(back.withColumn(jobs.KIND, F.lit(jobs.PUT))).withColumn(
        "seq", F.lit(0))


def _changed_orders(spark, sf_dir) -> Lake:
    """What is stored at first are the orders whose number does not leave 0 by 6; the stream runs once for each round."""
    folder = new_folder(spark)
    orders = spark.sql(_ORDER_SQL, orders=driver_table(spark, sf_dir, "orders"))
    lake = Lake(spark, f"{folder}/lake", {**layout(BUCKETS), "orders": Keyed(_ORDER, "order_id", BUCKETS)})
    lake.rewrite("orders", orders.where("order_id % 6 <> 0"))
    landing = f"{folder}/landing"
    for first in (True, False):
        _order_changes(orders, first).write.mode("append").parquet(landing)
        stream = jobs.file_stream(spark, landing, T.StructType([*_ORDER.fields, T.StructField(jobs.KIND, T.StringType()),
                                                                T.StructField("seq", T.IntegerType())]))
        jobs.stream_changes(stream, lake, f"{folder}/progress", "orders", ["seq"], _ORDER_FIELDS, as_of=AS_OF,
                            trigger=jobs.ONCE).awaitTermination()
    return lake


_ORDER_JSON = {"order_id": "n", "status": "t", "price": "n", "note": "t"}
_ORDERS = f"o AS ({_ORDER_SQL.format(orders='orders')})"
_GONE = "order_id % 6 IN (0, 2, 5) AND order_id % 5 = 0"


@check("stream_changes", f"""
    WITH {_ORDERS} SELECT order_id, status, CAST(price AS DOUBLE) AS price, note FROM o WHERE NOT ({_GONE})""")
def _stream_changes(spark, sf_dir):
    return _changed_orders(spark, sf_dir).read("orders")


@check("stream_changes_audit", f"""
    WITH {_ORDERS},
    edited AS (SELECT * REPLACE (price + 1 AS price, NULL AS note) FROM o),
    old AS (SELECT order_id, {json_sql(_ORDER_JSON)} AS doc, coalesce(note, '') <> '' AS noted FROM o),
    new AS (SELECT order_id, {json_sql(_ORDER_JSON)} AS doc FROM edited)
    SELECT CAST(order_id AS VARCHAR) AS row_key, 'INSERT' AS operation, CAST(NULL AS VARCHAR) AS before_row, doc AS after_row,
           CAST(NULL AS VARCHAR) AS changed_fields, CAST(1 AS BIGINT) AS audit_id FROM old WHERE order_id % 6 = 0
    UNION ALL
    SELECT CAST(order_id AS VARCHAR), 'UPDATE', old.doc, new.doc,
           CASE WHEN noted THEN '["price","note"]' ELSE '["price"]' END, 2
    FROM old JOIN new USING (order_id) WHERE order_id % 6 = 1
    UNION ALL
    SELECT CAST(order_id AS VARCHAR), 'UPDATE', new.doc, old.doc,
           CASE WHEN noted THEN '["price","note"]' ELSE '["price"]' END, 4
    FROM old JOIN new USING (order_id) WHERE order_id % 6 = 1
    UNION ALL
    SELECT CAST(order_id AS VARCHAR), 'DELETE', doc, NULL, NULL, 5 FROM old WHERE {_GONE}""")
def _stream_changes_audit(spark, sf_dir):
    rows = _changed_orders(spark, sf_dir).read("audit_row")
    return rows.select("row_key", "operation", "before_row", "after_row", "changed_fields", "audit_id")


@check("stream_changes_headers", f"""
    WITH {_ORDERS}
    SELECT audit_id, operation, rows_before, rows_after, changed_fields FROM (
        SELECT 1 AS audit_id, 'INSERT' AS operation, 0 AS rows_before, count(*) AS rows_after, NULL AS changed_fields
        FROM o WHERE order_id % 6 = 0
        UNION ALL SELECT 2, 'UPDATE', count(*), count(*), '["price","note"]' FROM o WHERE order_id % 6 = 1
        UNION ALL SELECT 4, 'UPDATE', count(*), count(*), '["price","note"]' FROM o WHERE order_id % 6 = 1
        UNION ALL SELECT 5, 'DELETE', count(*), 0, NULL FROM o WHERE {_GONE}) h
    WHERE rows_before + rows_after > 0""")
def _stream_changes_headers(spark, sf_dir):
    heads = _changed_orders(spark, sf_dir).read("audit")
    return heads.select("audit_id", "operation", "rows_before", "rows_after", "changed_fields")


def _report_part(part: str, same_as: str) -> None:
    """Every column of a part of the daily report is that of the query it stands for."""
    check(f"daily_report_{part}", REGISTRY[same_as].sql)(
        lambda spark, sf_dir: getattr(reports.daily_report(tables(spark, sf_dir), REPORT_DAY), part))


for _part, _query in (("summary", "report_summary"), ("top_now", "report_top_now"),
                      ("top_categories", "report_top_categories"), ("movers", "report_movers")):
    _report_part(_part, _query)


@check("daily_report", _with_latest(("entity", "category", "bridge", "snapshot", "rating"), f"""
    SELECT 'summary' AS part, '{REPORT_DAY}' AS name, CAST(sum(u.current_count) AS BIGINT) AS figure
    FROM entity e LEFT JOIN latest u ON u.entity_id = e.entity_id AND u.rn = 1
    UNION ALL
    SELECT * FROM (SELECT 'top_now', e.name, u.current_count FROM latest u JOIN entity e ON e.entity_id = u.entity_id
                   WHERE u.rn = 1 ORDER BY u.current_count DESC, e.entity_id LIMIT 5) a
    UNION ALL
    SELECT * FROM (SELECT 'top_categories', g.category_name, count(*) FROM category g
                   JOIN bridge b ON b.category_id = g.category_id JOIN entity e ON e.entity_id = b.entity_id
                   GROUP BY g.category_id, g.category_name ORDER BY count(*) DESC, g.category_id LIMIT 10) b
    UNION ALL
    SELECT * FROM (SELECT 'movers', e.name, a.current_count - p.current_count FROM latest a
                   JOIN latest p ON p.entity_id = a.entity_id AND p.rn = 2 JOIN entity e ON e.entity_id = a.entity_id
                   WHERE a.rn = 1 ORDER BY abs(a.current_count - p.current_count) DESC, e.entity_id LIMIT 5) c"""))
def _daily_report(spark, sf_dir):
    report = reports.daily_report(tables(spark, sf_dir), REPORT_DAY)
    parts = [("summary", report.summary, F.col("report_day").cast("string"), "current_total"),
             ("top_now", report.top_now, F.col("name"), "current_count"),
             ("top_categories", report.top_categories, F.col("category_name"), "entities"),
             ("movers", report.movers, F.col("name"), "change")]
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(part).alias("part"), name.alias("name"), F.col(figure).cast("long").alias("figure"))
        for part, df, name, figure in parts])
