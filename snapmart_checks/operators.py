"""Checks of filters, latest rows, differences, scalars, constraints and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart.driver_tables import driver_table, role
from snapmart.functions import scalars
from snapmart.operators import audit, filters, history, latest, quality, sync
from snapmart.sources.tables import to_json_rows
from snapmart_checks.base import AS_OF, check, json_sql, num, text

MEASURES = ["current_count", "peak_count", "total_ratings"]
ENTITY_TRACKED = ["name", "price", "released", "maker", "publisher"]


@check("latest_per_entity", """
    SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY entity_id
                   ORDER BY recorded_at DESC, snapshot_id DESC) AS recency FROM snapshot s) v
    WHERE recency <= 2""", ("snapshot",))
def _latest(spark, sf_dir):
    return latest.latest_per_group(role(spark, sf_dir, "snapshot"), "entity_id", ["recorded_at", "snapshot_id"], 2)


@check("snapshot_deltas", """
    SELECT s.*, current_count - lag(current_count, 1, current_count) OVER w AS delta_current_count,
           peak_count - lag(peak_count, 1, peak_count) OVER w AS delta_peak_count,
           total_ratings - lag(total_ratings, 1, total_ratings) OVER w AS delta_total_ratings
    FROM snapshot s WINDOW w AS (PARTITION BY entity_id ORDER BY recorded_at, snapshot_id)""", ("snapshot",))
def _deltas(spark, sf_dir):
    return history.deltas(role(spark, sf_dir, "snapshot"), "entity_id", ["recorded_at", "snapshot_id"], MEASURES)


@check("max_key", "SELECT coalesce(max(snapshot_id), 0) AS max_key FROM target_snapshot", ("target_snapshot",))
def _max_key(spark, sf_dir):
    return sync.max_key(role(spark, sf_dir, "target_snapshot"), "snapshot_id")


@check("scan_after_key", """
    SELECT snapshot_id, entity_id, current_count FROM snapshot
    WHERE snapshot_id > (SELECT max(snapshot_id) FROM target_snapshot)""", ("snapshot", "target_snapshot"))
def _scan_after_key(spark, sf_dir):
    seen = sync.highest(role(spark, sf_dir, "target_snapshot"), "snapshot_id")
    behind = filters.after_key(role(spark, sf_dir, "snapshot"), "snapshot_id", seen)
    return behind.select("snapshot_id", "entity_id", "current_count")


@check("apply_defaults", f"""
    SELECT entity_id, coalesce(maker, 'unknown') AS maker, coalesce(description, '') AS description,
           {num('price')}, CAST(coalesce(released, DATE '1970-01-01') AS VARCHAR) AS released FROM entity""",
       ("entity",))
def _apply_defaults(spark, sf_dir):
    filled = filters.with_defaults(role(spark, sf_dir, "entity"),
                                   {"maker": "unknown", "description": "", "price": 0, "released": "1970-01-01"})
    return filled.select("entity_id", "maker", "description", "price", "released")


@check("json_rows", """
    SELECT rating_id, concat('{"rating_id":', CAST(rating_id AS VARCHAR), ',"entity_id":', CAST(entity_id AS VARCHAR),
        ',"positive":', CAST(positive AS VARCHAR), ',"negative":', CAST(negative AS VARCHAR),
        ',"positive_pct":', CAST(CAST(positive_pct AS DOUBLE) AS VARCHAR),
        ',"label":', CASE WHEN label IS NULL THEN 'null' ELSE concat('"', label, '"') END, '}') AS row
    FROM rating""", ("rating",))
def _json_rows(spark, sf_dir):
    texts = to_json_rows(role(spark, sf_dir, "rating"))
    return texts.select(F.get_json_object("row", "$.rating_id").cast("long").alias("rating_id"), "row")


@check("json_times", """
    SELECT snapshot_id, CASE WHEN microsecond(recorded_at) % 1000000 = 0
                             THEN strftime(recorded_at, '%Y-%m-%dT%H:%M:%S')
                             ELSE strftime(recorded_at, '%Y-%m-%dT%H:%M:%S.%f') END AS recorded_at
    FROM snapshot""", ("snapshot",))
def _json_times(spark, sf_dir):
    texts = to_json_rows(role(spark, sf_dir, "snapshot").select("snapshot_id", "recorded_at"))
    return texts.select(F.from_json("row", "snapshot_id bigint, recorded_at string").alias("r")).select("r.*")


@check("rating_percent", """
    SELECT entity_id, CAST((positive * 20000 + positive + negative) // (2 * (positive + negative)) AS DOUBLE)
                      / 100.0 AS pct
    FROM rating""", ("rating",))
def _rating_percent(spark, sf_dir):
    return role(spark, sf_dir, "rating").select("entity_id", scalars.rating_percent("positive", "negative").alias("pct"))


@check("rating_band", """
    SELECT entity_id, CASE WHEN label IS NULL THEN '' WHEN label LIKE '%Positive%' THEN 'rating-pos'
                           WHEN label LIKE '%Negative%' THEN 'rating-neg' ELSE 'rating-mix' END AS band,
           CASE WHEN label IS NULL THEN '—' WHEN label = 'Very Positive' THEN 'Muy Pos.'
                WHEN label = 'Mostly Positive' THEN 'Mayorm+' WHEN label = 'Mixed' THEN 'Mixto'
                WHEN label = 'Mostly Negative' THEN 'Mayorm-' WHEN label = 'Very Negative' THEN 'Muy Neg.'
                ELSE label END AS short
    FROM rating""", ("rating",))
def _rating_band(spark, sf_dir):
    return role(spark, sf_dir, "rating").select(
        "entity_id", scalars.rating_band("label").alias("band"), scalars.short_label("label").alias("short"))


@check("price_label", """
    SELECT entity_id, CASE WHEN publisher = 'SMALL' THEN 'Free' ELSE concat('$', CAST(price AS VARCHAR)) END AS shown
    FROM entity""", ("entity",))
def _price_label(spark, sf_dir):
    price = F.when(F.col("publisher") == "SMALL", F.lit(0)).otherwise(F.col("price"))
    return role(spark, sf_dir, "entity").select("entity_id", scalars.price_text(price).alias("shown"))


@check("freshness", """
    SELECT entity_id, max(recorded_at) AS last_reading,
           CASE WHEN max(recorded_at) > TIMESTAMP '2024-01-30 23:59:00' - INTERVAL 10 HOUR
                THEN 'ACTIVO' ELSE 'INACTIVO' END AS state
    FROM snapshot GROUP BY entity_id""", ("snapshot",))
def _freshness(spark, sf_dir):
    last = role(spark, sf_dir, "snapshot").groupBy("entity_id").agg(F.max("recorded_at").alias("last_reading"))
    return last.withColumn(
        "state", scalars.freshness("last_reading", scalars.timestamp("2024-01-30 23:59:00"), minutes=600))


@check("parsed_dates", """
    SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN NULL
           WHEN event_type = 'view' THEN strftime(ts, '%Y-01-01') ELSE strftime(ts, '%Y-%m-%d') END AS parsed
    FROM events""")
def _parsed_dates(spark, sf_dir):
    events = driver_table(spark, sf_dir, "events")
    kind = F.col("event_type")
    shown = (
        F.when(kind == "error", F.date_format("ts", "'Q'q yyyy"))
        .when(kind == "view", F.date_format("ts", "yyyy"))
        .when(kind == "click", F.date_format("ts", "MMM d, yyyy"))
        .when(kind == "signup", F.date_format("ts", "dd MMMM, yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    return events.select("event_id", "event_type", scalars.parse_date(shown).alias("parsed"))


@check("check_violations", """
    SELECT entity_id, 'maker_not_null' AS rule FROM entity WHERE maker IS NULL
    UNION ALL SELECT entity_id, 'released_not_null' FROM entity WHERE released IS NULL
    UNION ALL SELECT entity_id, 'name_length' FROM entity WHERE length(name) > 10
    UNION ALL SELECT entity_id, 'price_not_negative' FROM entity WHERE price < 0
    UNION ALL SELECT entity_id, 'name_not_blank' FROM entity WHERE length(trim(name)) = 0""", ("entity",))
def _check_violations(spark, sf_dir):
    rules = [*quality.entity_rules(), *quality.not_null("maker", "released"), quality.max_length("name", 10)]
    return quality.check(role(spark, sf_dir, "entity"), ["entity_id"], rules)


@check("check_violations_snapshot", """
    SELECT snapshot_id, 'peak_above_current' AS rule FROM snapshot WHERE peak_count <= current_count
    UNION ALL SELECT snapshot_id, 'current_not_negative' FROM snapshot WHERE current_count < 0
    UNION ALL SELECT snapshot_id, 'peak_at_least_current' FROM snapshot WHERE peak_count < current_count""",
       ("snapshot",))
def _check_violations_snapshot(spark, sf_dir):
    strict = quality.Rule("peak_above_current", F.col("peak_count") > F.col("current_count"))
    return quality.check(role(spark, sf_dir, "snapshot"), ["snapshot_id"], [*quality.snapshot_rules(), strict])


@check("quarantine", """
    SELECT entity_id, name, concat_ws(',', CASE WHEN maker IS NULL THEN 'maker_not_null' END,
                                      CASE WHEN released IS NULL THEN 'released_not_null' END,
                                      CASE WHEN length(name) > 10 THEN 'name_length' END) AS reasons
    FROM entity WHERE maker IS NULL OR released IS NULL OR length(name) > 10""", ("entity",))
def _quarantine(spark, sf_dir):
    rules = [*quality.not_null("maker", "released"), quality.max_length("name", 10)]
    _, rejected = quality.split_valid(role(spark, sf_dir, "entity"), rules)
    return rejected.select("entity_id", "name", "reasons")


@check("unique_violations", """
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def _unique_violations(spark, sf_dir):
    lines = driver_table(spark, sf_dir, "lineitem")
    return quality.unique_violations(lines, ["l_orderkey", "l_linenumber"])


@check("fk_violations", """
    SELECT entity_id, category_id FROM bridge b
    WHERE NOT EXISTS (SELECT 1 FROM rating r WHERE r.entity_id = b.entity_id)""", ("bridge", "rating"))
def _fk_violations(spark, sf_dir):
    return quality.fk_violations(role(spark, sf_dir, "bridge"), "entity_id", role(spark, sf_dir, "rating"), "entity_id")


_DIFFERS = {
    "name": "b.name <> a.name",
    "price": "b.price <> a.price",
    "released": "coalesce(CAST(b.released AS VARCHAR), '') <> coalesce(CAST(a.released AS VARCHAR), '')",
    "maker": "coalesce(b.maker, '') <> coalesce(a.maker, '')",
    "publisher": "b.publisher <> a.publisher",
}
_LIST = "concat_ws(',', {})"


def _names(conditions: dict[str, str]) -> str:
    shown = ", ".join(f"""CASE WHEN {c} THEN '"{n}"' END""" for n, c in conditions.items())
    return f"concat('[', concat_ws(',', {shown}), ']')"


_ANY = {n: f"max(CASE WHEN {c} THEN 1 ELSE 0 END) = 1" for n, c in _DIFFERS.items()}
_IMAGES = ("before", "after")


def _images(spark, sf_dir):
    return [role(spark, sf_dir, n) for n in _IMAGES]


@check("changed_fields", f"""
    SELECT {_names(_ANY)} AS changed_fields
    FROM before b JOIN after a ON a.entity_id = b.entity_id""", _IMAGES)
def _changed_fields(spark, sf_dir):
    return audit.changed_fields(*_images(spark, sf_dir), "entity_id", ENTITY_TRACKED)


@check("changed_fields_long", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS field, count(*) AS rows_changed FROM before b JOIN after a ON a.entity_id = b.entity_id WHERE {c}"
    for n, c in _DIFFERS.items()) + ") v WHERE rows_changed > 0", _IMAGES)
def _changed_fields_long(spark, sf_dir):
    return audit.changed_fields_long(*_images(spark, sf_dir), "entity_id", ENTITY_TRACKED)


_ANY_OF = " OR ".join(f"({c})" for c in _DIFFERS.values())


@check("changed_rows", f"""
    SELECT a.entity_id, 'UPDATE' AS operation, {_names(_DIFFERS)} AS changed_fields
    FROM before b JOIN after a ON a.entity_id = b.entity_id WHERE {_ANY_OF}
    UNION ALL
    SELECT entity_id, 'INSERT', NULL FROM after WHERE entity_id NOT IN (SELECT entity_id FROM before)
    UNION ALL
    SELECT entity_id, 'DELETE', NULL FROM before WHERE entity_id NOT IN (SELECT entity_id FROM after)""", _IMAGES)
def _changed_rows(spark, sf_dir):
    return audit.changed_rows(*_images(spark, sf_dir), "entity_id", ENTITY_TRACKED)


_ENTITY_JSON = {"entity_id": "n", "name": "t", "price": "n", "released": "t", "maker": "t", "publisher": "t"}


def _of(alias: str, columns: dict[str, str]) -> dict[str, str]:
    return {f"{alias}.{n}": k for n, k in columns.items()}


def _touched_sql(before: str, after: str, key: str, shown: dict[str, str], differs: dict[str, str]) -> str:
    names = _names(differs)
    return f"""
    SELECT CAST(coalesce(b.{key}, a.{key}) AS VARCHAR) AS row_key,
           CASE WHEN b.{key} IS NULL THEN 'INSERT' WHEN a.{key} IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
           CASE WHEN b.{key} IS NOT NULL THEN {json_sql(_of('b', shown))} END AS before_row,
           CASE WHEN a.{key} IS NOT NULL THEN {json_sql(_of('a', shown))} END AS after_row,
           CASE WHEN b.{key} IS NOT NULL AND a.{key} IS NOT NULL AND {names} <> '[]' THEN {names} END AS changed_fields,
           'loader' AS user_name, TIMESTAMP '{AS_OF}' AS logged_at
    FROM {before} b FULL JOIN {after} a ON a.{key} = b.{key}"""


_TOUCHED = ("row_key", "operation", "before_row", "after_row", "changed_fields", "user_name", "logged_at")


@check("audit_batch", _touched_sql("before", "after", "entity_id", _ENTITY_JSON, _DIFFERS), _IMAGES)
def _audit_batch(spark, sf_dir):
    rows = audit.audit_rows(*_images(spark, sf_dir), "entity_id", ENTITY_TRACKED, "entity", "shop", as_of=AS_OF, user="loader")
    return rows.select(*_TOUCHED)


@check("audit_headers", f"""
    SELECT CAST(1 AS BIGINT) AS audit_id, 'shop' AS database_name, 'entity' AS table_name, 'UPDATE' AS operation,
           TIMESTAMP '{AS_OF}' AS logged_at, 'loader' AS user_name, (SELECT count(*) FROM before) AS rows_before,
           (SELECT count(*) FROM after) AS rows_after,
           (SELECT {_names(_ANY)} FROM before b JOIN after a ON a.entity_id = b.entity_id) AS changed_fields""", _IMAGES)
def _audit_headers(spark, sf_dir):
    rows = audit.audit_rows(*_images(spark, sf_dir), "entity_id", ENTITY_TRACKED, "entity", "shop", as_of=AS_OF, user="loader")
    return audit.audit_headers(rows, ENTITY_TRACKED)


_SNAPSHOT_JSON = {"snapshot_id": "n", "entity_id": "n", "current_count": "n", "peak_count": "n", "total_ratings": "n"}
_SNAPSHOT_DIFFERS = {n: f"b.{n} <> a.{n}" for n in MEASURES}


@check("audit_batch_snapshots", _touched_sql("snapshot", "corrected", "snapshot_id", _SNAPSHOT_JSON, _SNAPSHOT_DIFFERS),
       ("snapshot", "corrected"))
def _audit_batch_snapshots(spark, sf_dir):
    rows = audit.audit_rows(role(spark, sf_dir, "snapshot"), role(spark, sf_dir, "corrected"), "snapshot_id",
                            MEASURES, "snapshot", "shop", AS_OF, "loader", list(_SNAPSHOT_JSON))
    return rows.select(*_TOUCHED)


# Bytes of images in a part of a statement, small enough that the entities of the test tables take several.
PART_BYTES = 100_000


@check("statement_documents", f"""
    WITH touched AS ({_touched_sql("before", "after", "entity_id", _ENTITY_JSON, _DIFFERS)}),
    placed AS (SELECT *, coalesce(sum(coalesce(strlen(before_row), 0) + coalesce(strlen(after_row), 0)) OVER (
                 ORDER BY CAST(row_key AS BIGINT) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {PART_BYTES} AS place FROM touched)
    SELECT CAST(dense_rank() OVER (ORDER BY place) AS INTEGER) AS part, count(before_row) AS rows_before, count(after_row) AS rows_after,
           '[' || string_agg(before_row, ',' ORDER BY CAST(row_key AS BIGINT)) || ']' AS before_rows,
           '[' || string_agg(after_row, ',' ORDER BY CAST(row_key AS BIGINT)) || ']' AS after_rows
    FROM placed GROUP BY place""", _IMAGES)
def _statement_documents(spark, sf_dir):
    rows = audit.audit_rows(*_images(spark, sf_dir), "entity_id", ENTITY_TRACKED, "entity", "shop", as_of=AS_OF, user="loader")
    return audit.statement_documents(rows, PART_BYTES).select("part", "rows_before", "rows_after", "before_rows", "after_rows")


@check("statement_documents_parsed", f"""
    SELECT 'before' AS image, entity_id, name, {num('price')}, CAST(released AS VARCHAR) AS released, maker, publisher FROM before
    UNION ALL SELECT 'after', entity_id, name, {num('price')}, CAST(released AS VARCHAR), maker, publisher FROM after""", _IMAGES)
def _statement_documents_parsed(spark, sf_dir):
    """The rows that the arrays of all parts hold."""
    rows = audit.audit_rows(*_images(spark, sf_dir), "entity_id", ENTITY_TRACKED, "entity", "shop", as_of=AS_OF, user="loader")
    parts = audit.statement_documents(rows, PART_BYTES)
    entry = "array<struct<entity_id: long, name: string, price: decimal(10,2), released: date, maker: string, publisher: string>>"

    def parsed(image: str):
        return parts.select(F.lit(image).alias("image"), F.inline(F.from_json(f"{image}_rows", entry)))

    return parsed("before").unionByName(parsed("after"))


@check("audit_tail", """
    SELECT *, CASE WHEN changed_fields IS NULL THEN '—' WHEN changed_fields = '["price"]' THEN 'price'
                   ELSE 'name, price' END AS changed_text
    FROM (SELECT audit_id, database_name, table_name, operation, logged_at, user_name, changed_fields FROM audit
          ORDER BY logged_at DESC, audit_id DESC LIMIT 20) v""", ("audit",))
def _audit_tail(spark, sf_dir):
    return audit.audit_tail(role(spark, sf_dir, "audit"))


@check("audit_lookup", """
    SELECT audit_id, table_name, operation, logged_at, user_name FROM audit
    WHERE database_name = 'shop' AND table_name = 'rating' AND logged_at >= TIMESTAMP '1995-01-01 00:00:00'
      AND logged_at < TIMESTAMP '1996-01-01 00:00:00'""", ("audit",))
def _audit_lookup(spark, sf_dir):
    found = audit.audit_lookup(role(spark, sf_dir, "audit"), "shop", "rating", since="1995-01-01 00:00:00",
                               until="1996-01-01 00:00:00")
    return found.select("audit_id", "table_name", "operation", "logged_at", "user_name")
