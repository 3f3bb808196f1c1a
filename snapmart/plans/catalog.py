"""Queries over the catalogue: the three views and the three parameterised ones."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.operators.filters import filter_above, filter_at_least, filter_between
from snapmart.operators.history import history
from snapmart.roles import Roles, Tables

SEPARATOR = ", "


def category_lists(t: Tables, collation: str | None = None) -> DataFrame:
    """One row per entity: its category names in order, as one text.

    Names are ordered by their bytes or by a collation. The length of a list is bounded by the number of categories, since a pair
    stands in the bridge once.
    """
    r = t.roles
    named = t.bridge.join(t.category.select(r.category_id, r.category_name), r.category_id)
    name = f"`{r.category_name}`"
    order = name if collation is None else f"collate({name}, '{collation}'), {name}"
    ordered = F.expr(f"listagg({name}, '{SEPARATOR}') WITHIN GROUP (ORDER BY {order})")
    return named.groupBy(r.entity_id).agg(ordered.alias("categories"))


def top_entities(t: Tables, collation: str | None = None) -> DataFrame:
    """Every entity with its highest peak, last reading, categories and rating.

    Snapshots and bridge are reduced to one row per entity before any join, so
    no join multiplies rows and no group-by carries the entity columns.
    """
    r = t.roles
    peaks = t.snapshot.groupBy(r.entity_id).agg(
        F.max(r.peak_count).alias("highest_peak"), F.max(r.recorded_at).alias("last_reading")
    )
    ratings = t.rating.select(r.entity_id, r.positive_pct, r.label)
    return (
        t.entity.select(r.entity_id, r.external_id, r.name, r.maker, r.publisher, r.price, r.released)
        .join(peaks, r.entity_id, "left")
        .join(category_lists(t, collation), r.entity_id, "left")
        .join(ratings, r.entity_id, "left")
    )


def category_figures(t: Tables, how: str) -> DataFrame:
    """Per category of the bridge: number of entities, mean price, mean and best rating.

    The bridge is shuffled and sorted by entity once, for both look-ups and for telling repeated pairs: entities are
    counted once however often a pair stands in the bridge. So no task keeps a set of pairs, the sort can go to disk,
    and a category that holds a third of the bridge sends one row per task.
    """
    r = t.roles

    def numbered(df: DataFrame, column: str, number: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(r.entity_id).orderBy(r.entity_id))
        return df.select(r.entity_id, column).withColumn(number, nth)

    before = F.lag(r.category_id).over(Window.partitionBy(r.entity_id).orderBy(r.category_id))
    pairs = t.bridge.select(r.entity_id, r.category_id).where(
        F.col(r.entity_id).isNotNull() & F.col(r.category_id).isNotNull()).withColumn("__before", before)
    looked_up = (
        pairs.join(numbered(t.entity, r.price, "__price"), r.entity_id, how)
        .join(numbered(t.rating, r.positive_pct, "__rating"), r.entity_id, "left"))
    # a price or rating that stands there twice must not multiply the others
    one_price, one_rating = (F.coalesce(c, F.lit(1)) == 1 for c in ("__price", "__rating"))
    new = F.col("__before").isNull() | (F.col("__before") != F.col(r.category_id))
    return looked_up.groupBy(r.category_id).agg(
        F.count_if(new & one_price & one_rating).alias("entities"),
        F.avg(F.when(one_rating, F.col(r.price))).cast("decimal(10,2)").alias("mean_price"),
        F.avg(F.when(one_price, F.col(r.positive_pct))).cast("decimal(5,2)").alias("mean_rating"),
        F.max(r.positive_pct).cast("decimal(5,2)").alias("best_rating"),
    )


def by_category(t: Tables) -> DataFrame:
    """Every category with its number of entities, mean price, mean and best rating."""
    r = t.roles
    return (
        t.category.select(r.category_id, r.category_name)
        .join(category_figures(t, "left"), r.category_id, "left")
        .withColumn("entities", F.coalesce("entities", F.lit(0)))
        .select(r.category_id, r.category_name, "entities", "mean_price", "mean_rating", "best_rating")
    )


def best_rated(t: Tables, above=90) -> DataFrame:
    """Entities rated strictly above a percentage."""
    r = t.roles
    rated = filter_above(t.rating, r.positive_pct, above)
    return (
        t.entity.select(r.entity_id, r.name, r.maker, r.price, r.released)
        .join(rated.select(r.entity_id, r.positive, r.negative, r.positive_pct, r.label), r.entity_id)
        .withColumn("votes", F.col(r.positive) + F.col(r.negative))
    )


def by_price_range(t: Tables, low, high) -> DataFrame:
    """Entities in a price range, both ends included, with their rating if any."""
    r = t.roles
    priced = filter_between(t.entity, r.price, Decimal(str(low)), Decimal(str(high)))
    return priced.select(
        r.entity_id, r.external_id, r.name, r.price, r.maker, r.publisher, r.released
    ).join(t.rating.select(r.entity_id, r.positive_pct, r.label), r.entity_id, "left")


def by_min_rating(t: Tables, low) -> DataFrame:
    """Entities rated at least a percentage."""
    r = t.roles
    rated = filter_at_least(t.rating, r.positive_pct, Decimal(str(low)))
    return (
        t.entity.select(r.entity_id, r.external_id, r.name, r.price, r.maker)
        .join(rated.select(r.entity_id, r.positive, r.negative, r.positive_pct, r.label), r.entity_id)
        .withColumn("votes", F.col(r.positive) + F.col(r.negative))
    )


def entity_history(t: Tables, entity_id) -> DataFrame:
    """The series of one entity with the change since the reading before."""
    r = t.roles
    measures = [r.current_count, r.peak_count, r.total_ratings]
    series = t.snapshot.select(r.snapshot_id, r.entity_id, r.recorded_at, *measures)
    return history(series, r.entity_id, entity_id, [r.recorded_at, r.snapshot_id], measures).drop(r.entity_id)


def top_categories(t: Tables, k: int = 10) -> DataFrame:
    """The k categories with most entities."""
    r = t.roles
    ranked = by_category(t).orderBy(F.desc("entities"), F.asc(r.category_id)).limit(k)
    return ranked.select(r.category_name, "entities", "mean_price", "mean_rating")


SQL_NAMES = ("top_entities", "by_category", "best_rated", "by_price_range", "by_min_rating", "entity_history")


def register_sql(t: Tables, prefix: str = "", names: Sequence[str] = SQL_NAMES) -> None:
    """Offer the same queries in SQL, all or the named ones.

    Views ``top_entities``, ``by_category``, ``best_rated`` and table functions
    ``by_price_range(low, high)``, ``by_min_rating(low)``, ``entity_history(id)``;
    the functions also need views of the tables they read.
    """
    r, spark = t.roles, t.entity.sparkSession
    views = {"top_entities": top_entities, "by_category": by_category, "best_rated": best_rated}
    for name in names:
        if name in views:
            views[name](t).createOrReplaceTempView(prefix + name)
            continue
        read, signature, body = _table_function(name, r, prefix)
        for table in read:
            getattr(t, table).createOrReplaceTempView(prefix + table)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({signature}) RETURNS TABLE RETURN {body}")


def _table_function(name: str, r: Roles, prefix: str) -> tuple[tuple[str, ...], str, str]:
    """The tables a function reads, its parameters and its query."""
    if name == "by_price_range":
        return ("entity", "rating"), "low DECIMAL(10,2), high DECIMAL(10,2)", f"""
        SELECT e.{r.entity_id}, e.{r.external_id}, e.{r.name}, e.{r.price}, e.{r.maker}, e.{r.publisher},
               e.{r.released}, q.{r.positive_pct}, q.{r.label}
        FROM {prefix}entity e LEFT JOIN {prefix}rating q ON q.{r.entity_id} = e.{r.entity_id}
        WHERE e.{r.price} BETWEEN low AND high"""
    if name == "by_min_rating":
        return ("entity", "rating"), "low DECIMAL(5,2)", f"""
        SELECT e.{r.entity_id}, e.{r.external_id}, e.{r.name}, e.{r.price}, e.{r.maker}, q.{r.positive},
               q.{r.negative}, q.{r.positive_pct}, q.{r.label}, q.{r.positive} + q.{r.negative} AS votes
        FROM {prefix}entity e JOIN {prefix}rating q ON q.{r.entity_id} = e.{r.entity_id}
        WHERE q.{r.positive_pct} >= low"""
    if name != "entity_history":
        raise ValueError(f"unknown query {name!r}, use one of {', '.join(SQL_NAMES)}")
    measures = (r.current_count, r.peak_count, r.total_ratings)
    changes = ", ".join(
        f"s.{m} - CASE WHEN row_number() OVER w > 1 THEN lag(s.{m}) OVER w "
        f"WHEN c.ends IS NULL THEN s.{m} ELSE c.ends.{m} END AS delta_{m}" for m in measures
    )
    hour = f"date_trunc('HOUR', {r.recorded_at})"
    # as history.deltas: a window per hour, and the last values of the hour before for the first row of each
    return ("snapshot",), "id BIGINT", f"""
        SELECT s.{r.snapshot_id}, s.{r.recorded_at}, s.{r.current_count}, s.{r.peak_count}, s.{r.total_ratings},
               {changes}
        FROM {prefix}snapshot s
        JOIN (SELECT hour, lag(last_row) OVER (ORDER BY hour) AS ends
              FROM (SELECT {hour} AS hour,
                           max_by(struct({", ".join(measures)}), struct({r.recorded_at}, {r.snapshot_id})) AS last_row
                    FROM {prefix}snapshot WHERE {r.entity_id} = id GROUP BY 1)) c
          ON c.hour = date_trunc('HOUR', s.{r.recorded_at})
        WHERE s.{r.entity_id} = id
        WINDOW w AS (PARTITION BY date_trunc('HOUR', s.{r.recorded_at}) ORDER BY s.{r.recorded_at}, s.{r.snapshot_id})"""
