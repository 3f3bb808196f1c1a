"""Checks of table changes and synchronisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from snapmart.driver_tables import driver_table, role
from snapmart.operators import changes, sync
from snapmart.operators.changes import ForeignKey
from snapmart_checks.base import AS_OF, ROLE_COLUMNS, check, num, row_text, row_text_sql

ENTITY_COLUMNS = ["name", "price"]
_COPY = ("entity", "target_entity")


@check("new_entities", f"""
    SELECT entity_id, external_id, name, {num('price')} FROM entity
    WHERE external_id NOT IN (SELECT external_id FROM target_entity)""", _COPY)
def _new_entities(spark, sf_dir):
    sent = sync.recent_changes(role(spark, sf_dir, "entity"), role(spark, sf_dir, "target_entity"), "external_id",
                               "updated_at", AS_OF)
    return sent.where("is_new").select("entity_id", "external_id", "name", "price")


@check("recently_changed", f"""
    SELECT entity_id, external_id, name, {num('price')}, updated_at FROM entity
    WHERE updated_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
      AND external_id IN (SELECT external_id FROM target_entity)""", _COPY)
def _recently_changed(spark, sf_dir):
    sent = sync.recent_changes(role(spark, sf_dir, "entity"), role(spark, sf_dir, "target_entity"), "external_id",
                               "updated_at", AS_OF)
    return sent.where("NOT is_new").select("entity_id", "external_id", "name", "price", "updated_at")


@check("upsert_entities", f"""
    SELECT t.entity_id, t.external_id, s.name, {num('s.price')}, TIMESTAMP '2000-01-01 00:00:00' AS created_at,
           TIMESTAMP '{AS_OF}' AS updated_at
    FROM target_entity t JOIN entity s ON s.external_id = t.external_id
    UNION ALL
    SELECT (SELECT max(entity_id) FROM target_entity) + row_number() OVER (ORDER BY external_id), external_id, name,
           CAST(price AS DOUBLE), TIMESTAMP '{AS_OF}', TIMESTAMP '{AS_OF}'
    FROM entity WHERE external_id NOT IN (SELECT external_id FROM target_entity)""", _COPY)
def _upsert_entities(spark, sf_dir):
    born = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    target = role(spark, sf_dir, "target_entity").withColumns({"created_at": born, "updated_at": born})
    source = role(spark, sf_dir, "entity").select("external_id", *ENTITY_COLUMNS)
    return changes.upsert(target, source, ["external_id"], ENTITY_COLUMNS, AS_OF, "entity_id", "created_at",
                          "updated_at")


_VOTES = ["positive", "negative", "positive_pct", "label"]


@check("merge_ratings", f"""
    SELECT t.rating_id, t.entity_id, coalesce(s.positive, t.positive) AS positive,
           coalesce(s.negative, t.negative) AS negative, {num('coalesce(s.positive_pct, t.positive_pct)', 'positive_pct')},
           CASE WHEN s.entity_id IS NULL THEN t.label ELSE s.label END AS label
    FROM rating t LEFT JOIN new_rating s ON s.entity_id = t.entity_id
    UNION ALL
    SELECT (SELECT max(rating_id) FROM rating) + row_number() OVER (ORDER BY entity_id), entity_id, positive,
           negative, CAST(positive_pct AS DOUBLE), label
    FROM new_rating WHERE entity_id NOT IN (SELECT entity_id FROM rating)""", ("rating", "new_rating"))
def _merge_ratings(spark, sf_dir):
    merged = changes.merge(role(spark, sf_dir, "rating"), role(spark, sf_dir, "new_rating"), ["entity_id"], _VOTES,
                           "rating_id")
    return merged.drop(changes.ACTION)


@check("ensure_categories", """
    SELECT category_id, category_name FROM category
    UNION ALL
    SELECT (SELECT max(category_id) FROM category) + row_number() OVER (ORDER BY c_name), c_name
    FROM (SELECT DISTINCT c_name FROM customer WHERE c_name NOT IN (SELECT category_name FROM category)) v""",
       ("category",))
def _ensure_categories(spark, sf_dir):
    category = role(spark, sf_dir, "category")
    customers = driver_table(spark, sf_dir, "customer").select(F.col("c_name").alias("category_name"))
    names = customers.unionByName(category.select("category_name"))
    return changes.ensure_dimension(category, names, "category_id", "category_name")


@check("replace_children", """
    SELECT entity_id, category_id FROM bridge WHERE entity_id NOT IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')
    UNION ALL
    SELECT DISTINCT l_partkey, l_suppkey FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE p_type = 'ECONOMY' AND l_quantity >= 45""", ("bridge",))
def _replace_children(spark, sf_dir):
    parts = driver_table(spark, sf_dir, "part").where("p_type = 'ECONOMY'")
    touched = parts.select(F.col("p_partkey").alias("entity_id"))
    lines = driver_table(spark, sf_dir, "lineitem").where("l_quantity >= 45")
    pairs = lines.select(F.col("l_partkey").alias("entity_id"), F.col("l_suppkey").alias("category_id"))
    return changes.replace_children(role(spark, sf_dir, "bridge"), pairs.join(touched, "entity_id", "left_semi"),
                                    "entity_id", touched)


_FOREIGN_KEYS = [ForeignKey(child, "entity_id", "entity", "entity_id") for child in ("bridge", "snapshot", "rating")]
_FAMILY = ("entity", "bridge", "snapshot", "rating")


_KEPT = "WHERE entity_id NOT IN (SELECT entity_id FROM entity WHERE publisher = 'ECONOMY')"


@check("cascade_delete", " UNION ALL ".join(row_text_sql(f"{n} {_KEPT}", n, ROLE_COLUMNS[n]) for n in _FAMILY), _FAMILY)
def _cascade_delete(spark, sf_dir):
    family = {n: role(spark, sf_dir, n) for n in _FAMILY}
    doomed = family["entity"].where("publisher = 'ECONOMY'").select("entity_id")
    left = changes.cascade_delete(family, _FOREIGN_KEYS, "entity", doomed, "entity_id")
    return reduce(lambda a, b: a.unionByName(b), [row_text(left[n], n) for n in _FAMILY])


_MOVED = """(SELECT {columns}, CASE WHEN o.id IS NULL THEN t.entity_id ELSE t.entity_id + 1000000000 END AS moved_id
    FROM {table} t LEFT JOIN (SELECT entity_id AS id FROM entity WHERE publisher = 'ECONOMY') o ON o.id = t.entity_id) {table}_moved"""


def _moved_sql(table: str) -> str:
    others = [c for c in ROLE_COLUMNS[table] if c != "entity_id"]
    source = _MOVED.format(table=table, columns=", ".join(f"t.{c}" for c in others))
    return row_text_sql(source, table, [*others, "moved_id AS entity_id"])


@check("cascade_rekey", " UNION ALL ".join(map(_moved_sql, _FAMILY)), _FAMILY)
def _cascade_rekey(spark, sf_dir):
    family = {n: role(spark, sf_dir, n) for n in _FAMILY}
    mapping = family["entity"].where("publisher = 'ECONOMY'").select(
        F.col("entity_id").alias("old_key"), (F.col("entity_id") + 1_000_000_000).alias("new_key"))
    moved = changes.cascade_rekey(family, _FOREIGN_KEYS, "entity", "entity_id", mapping)
    return reduce(lambda a, b: a.unionByName(b), [row_text(moved[n], n) for n in _FAMILY])


# Every fourth entity comes a second time, renamed, under a key of its own behind all others.
_AGAIN = 1_000_000_000
_TWICE = f"""(SELECT entity_id, external_id, name, price FROM entity
    UNION ALL SELECT entity_id + {_AGAIN}, external_id, upper(name), price FROM entity WHERE entity_id % 4 = 0)"""


def _twice(spark, sf_dir):
    rows = role(spark, sf_dir, "entity").select("entity_id", "external_id", "name", "price")
    again = rows.where("entity_id % 4 = 0").withColumns({"entity_id": F.col("entity_id") + _AGAIN, "name": F.upper("name")})
    return rows.unionByName(again)


@check("sync_insert_ignore", f"""
    SELECT entity_id, external_id, name, {num('price')}
    FROM (SELECT e.*, row_number() OVER (PARTITION BY external_id ORDER BY entity_id) AS n FROM {_TWICE} e
          WHERE entity_id > (SELECT max(entity_id) FROM target_entity)) v
    WHERE n = 1 AND external_id NOT IN (SELECT external_id FROM target_entity)""", _COPY)
def _sync_insert_ignore(spark, sf_dir):
    new = sync.insert_ignore(_twice(spark, sf_dir), role(spark, sf_dir, "target_entity"), "entity_id", ["entity_id"],
                             "external_id")
    return new.select("entity_id", "external_id", "name", "price")


@check("sync_upsert_clashes", f"""
    WITH new AS (SELECT * FROM {_TWICE} e WHERE entity_id > (SELECT max(entity_id) FROM target_entity)
                 QUALIFY row_number() OVER (PARTITION BY external_id ORDER BY entity_id DESC) = 1)
    SELECT t.entity_id, t.external_id, coalesce(n.name, t.name) AS name, CAST(coalesce(n.price, t.price) AS DOUBLE) AS price
    FROM target_entity t LEFT JOIN new n ON n.external_id = t.external_id
    UNION ALL
    SELECT entity_id, external_id, name, CAST(price AS DOUBLE) FROM new
    WHERE external_id NOT IN (SELECT external_id FROM target_entity)""", _COPY)
def _sync_upsert_clashes(spark, sf_dir):
    return sync.upsert_gap(_twice(spark, sf_dir), role(spark, sf_dir, "target_entity"), "entity_id", ENTITY_COLUMNS, "external_id")


@check("sync_upsert", f"""
    SELECT entity_id, external_id, name, {num('price')} FROM target_entity
    UNION ALL
    SELECT entity_id, external_id, name, CAST(price AS DOUBLE) FROM entity
    WHERE entity_id > (SELECT max(entity_id) FROM target_entity)""", _COPY)
def _sync_upsert(spark, sf_dir):
    return sync.upsert_gap(role(spark, sf_dir, "entity"), role(spark, sf_dir, "target_entity"), "entity_id",
                           ["external_id", *ENTITY_COLUMNS])


@check("sync_bridge", """
    SELECT entity_id, category_id FROM bridge
    WHERE entity_id > (SELECT max(entity_id) FROM target_entity)""", ("bridge", "target_entity"))
def _sync_bridge(spark, sf_dir):
    return sync.insert_ignore(role(spark, sf_dir, "bridge"), role(spark, sf_dir, "target_entity"), "entity_id",
                              ["entity_id", "category_id"])


@check("sync_append_gap", """
    SELECT * FROM snapshot WHERE snapshot_id > (SELECT max(snapshot_id) FROM target_snapshot)""",
       ("snapshot", "target_snapshot"))
def _sync_append_gap(spark, sf_dir):
    return sync.append_gap(role(spark, sf_dir, "snapshot"), role(spark, sf_dir, "target_snapshot"), "snapshot_id")


@check("sync_recent_changes", f"""
    SELECT t.entity_id, t.external_id, coalesce(s.name, t.name) AS name,
           {num('coalesce(s.price, t.price)', 'price')}
    FROM target_entity t
    LEFT JOIN (SELECT * FROM entity WHERE updated_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR) s
      ON s.external_id = t.external_id
    UNION ALL
    SELECT entity_id, external_id, name, CAST(price AS DOUBLE) FROM entity
    WHERE external_id NOT IN (SELECT external_id FROM target_entity)""", _COPY)
def _sync_recent_changes(spark, sf_dir):
    return sync.apply_recent_changes(role(spark, sf_dir, "entity"), role(spark, sf_dir, "target_entity"),
                                     "external_id", "updated_at", AS_OF)
