"""Checks of the JSON feeds; Spark writes the raw texts from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.driver_tables import dealt, driver_table, role
from snapmart.sources import feeds
from snapmart_checks.base import check, num, text


def raw_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per event with three entries; counts are missing here and there."""
    events = driver_table(spark, sf_dir, "events")

    def entry(app, count, peak):
        return F.struct(app.alias("appid"), count.cast("long").alias("concurrent_in_game"),
                        peak.cast("long").alias("peak_in_game"))

    count = F.round(F.col("value") * 100)
    ranks = F.array(
        entry(F.col("user_id"), count, F.lit(None)),
        entry(F.col("event_id") + 5, F.when(F.col("event_type") != "error", count), count + 9),
        entry(F.lit(1).cast("long"), count, count),
    )
    return events.select("event_id", F.to_json(F.struct(F.struct(ranks.alias("ranks")).alias("response"))).alias("body"))


@check("feed_ranking", """
    SELECT event_id, 0 AS position, user_id AS external_id, CAST(round(value * 100) AS BIGINT) AS ranked_count,
           CAST(0 AS BIGINT) AS ranked_peak FROM events
    UNION ALL
    SELECT event_id, 1, event_id + 5, CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END,
           CAST(round(value * 100) AS BIGINT) + 9 FROM events""")
def _feed_ranking(spark, sf_dir):
    return feeds.read_ranking(raw_ranking(spark, sf_dir), 2)


def raw_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per entity; some fail, some lack price, maker or date."""
    e = role(spark, sf_dir, "entity", {"part": "p_partkey"})
    data = F.struct(
        F.concat(F.lit("  "), "name", F.lit(" ")).alias("name"),
        F.col("description").alias("short_description"),
        F.when(F.col("publisher") != "SMALL", F.struct((F.col("price") * 100).cast("long").alias("final")))
        .alias("price_overview"),
        F.struct(F.coalesce(F.date_format("released", "d MMM, yyyy"), F.lit("Coming Soon")).alias("date"))
        .alias("release_date"),
        F.when(F.col("maker").isNotNull(), F.array("maker", "publisher"))
        .otherwise(F.array().cast("array<string>")).alias("developers"),
        F.array("publisher").alias("publishers"),
        F.array(F.struct(F.col("publisher").alias("description")), F.struct(F.lit("Indie").alias("description")))
        .alias("genres"),
    )
    entry = F.struct((F.col("maker").isNull() | (F.col("maker") != "Brand#17")).alias("success"), data.alias("data"))
    body = F.to_json(F.create_map(F.col("external_id").cast("string"), entry))
    return e.select("external_id", body.alias("body"))


_DETAILS_SQL = f"""
    SELECT external_id, name, coalesce(description, '') AS description,
           CASE WHEN publisher <> 'SMALL' THEN CAST(price AS DOUBLE) ELSE 0 END AS price,
           {text('released')}, CASE WHEN maker IS NULL THEN NULL ELSE concat(maker, ', ', publisher) END AS maker,
           publisher, concat(publisher, '|Indie') AS categories
    FROM entity WHERE maker IS NULL OR maker <> 'Brand#17'"""


@check("feed_details", _DETAILS_SQL, ("entity",))
def _feed_details(spark, sf_dir):
    return feeds.read_details(raw_details(spark, sf_dir)).withColumn("categories", F.array_join("categories", "|"))


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = role(spark, sf_dir, "rating")
    totals = F.struct(
        F.when(F.col("positive") > 0, F.col("positive")).alias("total_positive"),
        F.col("negative").alias("total_negative"),
        F.coalesce("label", F.lit("")).alias("review_score_desc"),
    )
    answer = F.struct(F.when(F.col("positive_pct") > 20, 1).otherwise(0).alias("success"), totals.alias("query_summary"))
    return r.select((F.col("entity_id") * 10 + 7).alias("external_id"), F.to_json(answer).alias("body"))


@check("feed_ratings", """
    SELECT entity_id * 10 + 7 AS external_id, positive, negative, label FROM rating WHERE positive_pct > 20""",
       ("rating",))
def _feed_ratings(spark, sf_dir):
    return feeds.read_ratings(raw_ratings(spark, sf_dir))


def raw_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer per part; parts without a size over 25 have no live count."""
    parts = dealt(driver_table(spark, sf_dir, "part"), "p_partkey")
    result = F.when(F.col("p_size") > 25, 1).otherwise(42)
    count = F.when(F.col("p_size") != 30, F.col("p_size") * 100)
    answer = F.struct(F.struct(result.alias("result"), count.alias("player_count")).alias("response"))
    return parts.select((F.col("p_partkey") * 10 + 7).alias("external_id"), F.to_json(answer).alias("body"))


_CURRENT_SQL = """
    SELECT p_partkey * 10 + 7 AS external_id,
           CAST(CASE WHEN p_size <> 30 THEN p_size * 100 ELSE 0 END AS BIGINT) AS live_count
    FROM part WHERE p_size > 25"""


@check("feed_current", _CURRENT_SQL)
def _feed_current(spark, sf_dir):
    return feeds.read_current(raw_current(spark, sf_dir))


def raw_item_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ranking document per part, holding that part."""
    parts = dealt(driver_table(spark, sf_dir, "part"), "p_partkey")
    entry = F.struct((F.col("p_partkey") * 10 + 7).alias("appid"), (F.col("p_size") * 90).alias("concurrent_in_game"),
                     (F.col("p_size") * 95).alias("peak_in_game"))
    return parts.select(F.to_json(F.struct(F.struct(F.array(entry).alias("ranks")).alias("response"))).alias("body"))


@check("assemble_feed", f"""
    SELECT 0 AS position, d.external_id, d.name, d.description, d.price, d.released, d.maker, d.publisher, d.categories,
           coalesce(c.live_count, p.p_size * 90) AS current_count,
           greatest(p.p_size * 95, coalesce(c.live_count, p.p_size * 90)) AS peak_count,
           coalesce(r.positive + r.negative, 0) AS total_ratings, r.external_id IS NOT NULL AS rated,
           r.positive, r.negative, CAST(coalesce(r.positive_pct, 0) AS DOUBLE) AS positive_pct, r.label
    FROM part p
    JOIN ({_DETAILS_SQL}) d ON d.external_id = p.p_partkey * 10 + 7
    LEFT JOIN (SELECT *, entity_id * 10 + 7 AS external_id FROM rating WHERE positive_pct > 20) r
           ON r.external_id = d.external_id
    LEFT JOIN ({_CURRENT_SQL}) c ON c.external_id = d.external_id""", ("entity", "rating"))
def _assemble_feed(spark, sf_dir):
    rows = feeds.assemble(
        feeds.read_ranking(raw_item_ranking(spark, sf_dir)), feeds.read_details(raw_details(spark, sf_dir)),
        feeds.read_ratings(raw_ratings(spark, sf_dir)), feeds.read_current(raw_current(spark, sf_dir)))
    return rows.withColumn("categories", F.array_join("categories", "|"))
