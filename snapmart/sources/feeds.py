"""Raw JSON feeds into columns.

A raw feed is a DataFrame with the JSON text in ``body``. Feeds that are
fetched per item also carry the item's ``external_id``. Further columns, such as
the time of the poll, are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import scalars

# Shapes of the documents, only the fields that are read.
_RANKING = "response struct<ranks: array<struct<appid: bigint, concurrent_in_game: bigint, peak_in_game: bigint>>>"
_DETAILS = """map<string, struct<success: boolean, data: struct<
    name: string, short_description: string,
    price_overview: struct<final: bigint>,
    release_date: struct<date: string>,
    developers: array<string>, publishers: array<string>,
    genres: array<struct<description: string>>>>>"""
_RATINGS = """success int, query_summary struct<
    total_positive: bigint, total_negative: bigint, review_score_desc: string>"""
_CURRENT = "response struct<result: int, player_count: bigint>"

NAME_LENGTH = 255


def _parsed(schema: str) -> Column:
    return F.from_json("body", schema)


def _kept(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in ("body", "external_id")]


def read_ranking(raw: DataFrame, n: int = 100) -> DataFrame:
    """First ``n`` entries in feed order: ``position, external_id, ranked_count, ranked_peak``."""
    keep = _kept(raw)
    entries = raw.select(*keep, F.posexplode(_parsed(_RANKING)["response"]["ranks"]).alias("position", "entry"))
    return entries.where(F.col("position") < n).select(
        *keep,
        "position",
        F.col("entry.appid").alias("external_id"),
        F.coalesce("entry.concurrent_in_game", F.lit(0)).alias("ranked_count"),
        F.coalesce("entry.peak_in_game", F.lit(0)).alias("ranked_peak"),
    )


def read_details(raw: DataFrame) -> DataFrame:
    """Successful entries, flattened; ``categories`` stays an array."""
    keep = _kept(raw)
    entries = raw.select(*keep, F.explode(_parsed(_DETAILS)).alias("external_id", "entry")).where("entry.success")
    return entries.select(*keep, F.col("external_id").try_cast("long").alias("external_id"), *_flattened(F.col("entry.data")))


def _flattened(data: Column) -> list[Column]:
    return [
        scalars.strip(F.coalesce(data["name"], F.lit(""))).alias("name"),
        F.coalesce(data["short_description"], F.lit("")).alias("description"),
        scalars.cents_to_price(data["price_overview"]["final"]).alias("price"),
        scalars.parse_date(data["release_date"]["date"]).alias("released"),
        scalars.joined(data["developers"]).alias("maker"),
        scalars.joined(data["publishers"]).alias("publisher"),
        F.coalesce(data["genres"]["description"], F.array().cast("array<string>")).alias("categories"),
    ]


def unreadable_details(raw: DataFrame) -> DataFrame:
    """Documents that are no JSON of this shape, or whose key is no number, with ``reasons``.

    ``external_id`` is that of the fetch.
    """
    keep = [*_kept(raw), "external_id"]
    entries = raw.select(*keep, F.explode_outer(_parsed(_DETAILS)).alias("__key", "__entry"))
    return entries.select(*keep, _unreadable("__key").alias("reasons")).where(F.col("reasons").isNotNull())


def _unreadable(key: str) -> Column:
    return F.when(F.col(key).isNull(), "details_readable").when(F.col(key).try_cast("long").isNull(), "details_key_readable")


def all_details(raw: DataFrame) -> DataFrame:
    """The rows of ``read_details``, with ``success``, and those of ``unreadable_details``, with ``reasons``, from one parse.

    A document whose key is no number may be both. ``fetched_id`` is the ``external_id`` of the fetch.
    """
    keep = _kept(raw)
    entries = raw.select(*keep, F.col("external_id").alias("fetched_id"),
                         F.explode_outer(_parsed(_DETAILS)).alias("__key", "__entry"))
    return entries.select(
        *keep, "fetched_id", F.col("__key").try_cast("long").alias("external_id"), *_flattened(F.col("__entry.data")),
        F.coalesce("__entry.success", F.lit(False)).alias("success"), _unreadable("__key").alias("reasons"),
    ).where(F.col("success") | F.col("reasons").isNotNull())


def read_ratings(raw: DataFrame) -> DataFrame:
    """Answers with success 1: ``external_id, positive, negative, label``."""
    keep = [*_kept(raw), "external_id"]
    parsed = raw.select(*keep, _parsed(_RATINGS).alias("r")).where("r.success = 1")
    return parsed.select(
        *keep,
        F.coalesce("r.query_summary.total_positive", F.lit(0)).alias("positive"),
        F.coalesce("r.query_summary.total_negative", F.lit(0)).alias("negative"),
        F.nullif(F.col("r.query_summary.review_score_desc"), F.lit("")).alias("label"),
    )


def read_current(raw: DataFrame) -> DataFrame:
    """Answers with result 1: ``external_id, live_count``."""
    keep = [*_kept(raw), "external_id"]
    parsed = raw.select(*keep, _parsed(_CURRENT).alias("r")).where("r.response.result = 1")
    return parsed.select(*keep, F.coalesce("r.response.player_count", F.lit(0)).alias("live_count"))


def assemble(ranking: DataFrame, details: DataFrame, ratings: DataFrame, current: DataFrame,
             poll: str | None = None) -> DataFrame:
    """One row per ranked item that has a name, with all its figures.

    The live count wins over the ranked one, the peak is at least the count, and
    ``rated`` tells whether there was a ratings answer. Details, ratings and
    live counts hold one row per item; with ``poll``, the column that tells the
    polls apart, one row per item and poll.
    """
    keys = ["external_id"] if poll is None else [poll, "external_id"]
    rated = ratings.withColumn("rated", F.lit(True))
    joined = (
        ranking.join(details.where(F.col("name") != ""), keys)
        .join(rated, keys, "left")
        .join(current, keys, "left")
    )
    count = F.coalesce("live_count", "ranked_count")
    return joined.select(
        *keys, "position",
        F.substring("name", 1, NAME_LENGTH).alias("name"),
        "description", "price", "released", "maker", "publisher", "categories",
        count.alias("current_count"),
        F.greatest("ranked_peak", count).alias("peak_count"),
        F.when(F.col("rated"), F.try_add("positive", "negative")).otherwise(F.lit(0)).alias("total_ratings"),
        F.coalesce("rated", F.lit(False)).alias("rated"),
        "positive", "negative",
        scalars.rating_percent("positive", "negative").alias("positive_pct"),
        scalars.allowed_label("label").alias("label"),
    )
