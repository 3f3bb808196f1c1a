"""Checks of how tables are laid out: buckets by key, digests, bitmaps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.driver_tables import role
from snapmart.operators import distinct, latest
from snapmart.plans.sync_job import sync_digests
from snapmart.schema import RATING, SNAPSHOT
from snapmart.sources.bucketed import read_bucketed, save_bucketed, sorted_deltas
from snapmart.sources.clustered import look_up, save_clustered
from snapmart.sources.lake import Keyed, Lake
from snapmart.streaming import jobs
from snapmart.streaming.deltas import Readings, deltas_into
from snapmart_checks.base import REGISTRY, ROLE_COLUMNS, check, num, row_text, row_text_sql
from snapmart_checks.operators import MEASURES
from snapmart_checks.stores import new_folder

ORDER = ["recorded_at", "snapshot_id"]


def bucketed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings in a table of their own, bucketed by entity and sorted by time."""
    name = f"readings_{uuid.uuid4().hex}"
    save_bucketed(role(spark, sf_dir, "snapshot"), name, "entity_id", ORDER, 8, f"{new_folder(spark)}/{name}")
    return read_bucketed(spark, name)


@check("bucketed_latest", REGISTRY["stream_latest"].sql)
def bucketed_latest(spark, sf_dir):
    return latest.newest_per_group(bucketed_readings(spark, sf_dir), ["entity_id"], ORDER)


@check("bucketed_pairs", """
    WITH numbered AS (SELECT s.*, row_number() OVER (PARTITION BY entity_id ORDER BY recorded_at DESC, snapshot_id DESC) AS n FROM snapshot s)
    SELECT a.entity_id, a.current_count, a.peak_count, p.current_count AS previous_current_count, p.peak_count AS previous_peak_count
    FROM numbered a JOIN numbered p ON p.entity_id = a.entity_id AND p.n = 2 WHERE a.n = 1""", ("snapshot",))
def bucketed_pairs(spark, sf_dir):
    return latest.latest_pair(bucketed_readings(spark, sf_dir), "entity_id", ORDER, ["current_count", "peak_count"])


@check("bucketed_deltas", REGISTRY["snapshot_deltas"].sql)
def bucketed_deltas(spark, sf_dir):
    return sorted_deltas(bucketed_readings(spark, sf_dir), "entity_id", ORDER, MEASURES)


def _day_maps(spark, sf_dir) -> DataFrame:
    return distinct.bitmaps(role(spark, sf_dir, "snapshot"), "entity_id", {"day": F.col("recorded_at").cast("date")})


@check("distinct_by_day", "SELECT CAST(CAST(recorded_at AS DATE) AS VARCHAR) AS day, count(DISTINCT entity_id) AS entities FROM snapshot GROUP BY 1",
       ("snapshot",))
def distinct_by_day(spark, sf_dir):
    return distinct.counted(_day_maps(spark, sf_dir), ["day"], "entities")


@check("distinct_by_week", """
    SELECT CAST(CAST(date_trunc('week', recorded_at) AS DATE) AS VARCHAR) AS week, count(DISTINCT entity_id) AS entities
    FROM snapshot GROUP BY 1""", ("snapshot",))
def distinct_by_week(spark, sf_dir):
    """Weeks from the bitmaps of days."""
    weeks = distinct.merged(_day_maps(spark, sf_dir), {"week": F.date_trunc("week", "day").cast("date")})
    return distinct.counted(weeks, ["week"], "entities")


@check("distinct_in_all", "SELECT count(DISTINCT entity_id) AS entities FROM snapshot", ("snapshot",))
def distinct_in_all(spark, sf_dir):
    return distinct.counted(distinct.merged(_day_maps(spark, sf_dir)), name="entities")


@check("look_up_readings", """
    SELECT snapshot_id, entity_id, current_count, recorded_at FROM snapshot
    WHERE entity_id = 3 AND recorded_at >= TIMESTAMP '2024-01-05 00:00:00' AND recorded_at < TIMESTAMP '2024-01-25 00:00:00'""",
       ("snapshot",))
def look_up_readings(spark, sf_dir):
    path = new_folder(spark)
    save_clustered(role(spark, sf_dir, "snapshot"), path, ["entity_id", "recorded_at"], 8)
    found = look_up(spark.read.parquet(path), "entity_id", 3, "recorded_at", "2024-01-05 00:00:00", "2024-01-25 00:00:00")
    return found.select("snapshot_id", "entity_id", "current_count", "recorded_at")


@check("look_up_entity", f"""
    SELECT entity_id, name, {num('price')} FROM entity WHERE description = (SELECT max(description) FROM entity)""", ("entity",))
def look_up_entity(spark, sf_dir):
    """An entity by a text that stands anywhere in the table."""
    path, rows = new_folder(spark), role(spark, sf_dir, "entity")
    save_clustered(rows, path, ["entity_id"], 4, {"description": 100_000})
    wanted = rows.agg(F.max("description")).first()[0]
    return look_up(spark.read.parquet(path), "description", wanted).select("entity_id", "name", "price")


READINGS = Readings(SNAPSHOT, "snapshot_id", "entity_id", tuple(ORDER), tuple(MEASURES))


@check("stream_deltas", REGISTRY["snapshot_deltas"].sql)
def stream_deltas(spark, sf_dir):
    """Readings arrive in three rounds without order, some of them twice; the differences are right at the end."""
    folder = new_folder(spark)
    lake = Lake(spark, f"{folder}/lake", READINGS.tables(8))
    landing, progress = f"{folder}/landing", f"{folder}/progress"
    rows = role(spark, sf_dir, "snapshot")
    turn = F.pmod(F.xxhash64("snapshot_id"), F.lit(3))
    for i in range(3):
        rows.where((turn == i) | (F.col("snapshot_id") % 11 == i)).write.mode("append").parquet(landing)
        stream = jobs.file_stream(spark, landing, SNAPSHOT)
        stream.writeStream.foreachBatch(jobs.into(lake, progress, deltas_into(READINGS))).option(
            "checkpointLocation", progress).trigger(**jobs.ONCE).start().awaitTermination()
    return lake.read("reading_delta")


_BUCKETS = 32
# Ratings whose copy differs: they are missing, changed without a trace, or another row stands beside them.
_ODD = "entity_id BETWEEN 20 AND 24"


def differing_lakes(spark: SparkSession, sf_dir: str) -> tuple[Lake, Lake]:
    folder, spec = new_folder(spark), {"rating": Keyed(RATING, "entity_id", _BUCKETS, digested=True)}
    source, copy = (Lake(spark, f"{folder}/{n}", spec) for n in ("source", "copy"))
    rows = role(spark, sf_dir, "rating")
    source.rewrite("rating", rows)
    odd = rows.where(_ODD)
    changed = odd.where("entity_id % 2 = 0").withColumn("positive", F.col("positive") + 5)
    extra = odd.withColumns({"entity_id": -F.col("entity_id"), "rating_id": -F.col("rating_id")})
    copy.rewrite("rating", rows.where(f"NOT ({_ODD})").unionByName(changed).unionByName(extra))
    return source, copy


@check("sync_digests", row_text_sql("rating", "rating", ROLE_COLUMNS["rating"]), ("rating",))
def sync_digests_check(spark, sf_dir):
    """A copy with deleted, changed and foreign rows, made equal by the buckets that differ."""
    source, copy = differing_lakes(spark, sf_dir)
    sync_digests(source, copy, ["rating"])
    return row_text(copy.read("rating").select(*ROLE_COLUMNS["rating"]), "rating")
