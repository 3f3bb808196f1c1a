"""The daily report, the summary figures and the list of the moment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import scalars
from snapmart.operators.latest import latest_per_group, pair_up, top_k, with_position
from snapmart.plans.catalog import category_figures
from snapmart.roles import Tables
from snapmart.session import ensure_checkpoint_dir


def _last_rows(t: Tables, k: int) -> DataFrame:
    r = t.roles
    series = t.snapshot.select(r.entity_id, r.recorded_at, r.snapshot_id, r.current_count, r.peak_count)
    return latest_per_group(series, r.entity_id, [r.recorded_at, r.snapshot_id], k)


def _newest(t: Tables, last_rows: DataFrame | None) -> DataFrame:
    r = t.roles
    rows = _last_rows(t, 1) if last_rows is None else last_rows.where(F.col("recency") == 1)
    return rows.select(r.entity_id, r.current_count, r.peak_count, r.recorded_at)


def _figures(t: Tables, today: Column) -> dict[str, Column]:
    r = t.roles
    return {
        "entities": F.count_distinct(r.entity_id),
        "rated_entities": F.count_distinct(r.rating_id),
        "current_total": F.sum(r.current_count),
        "current_mean": F.avg(F.col(r.current_count).cast("double")).cast("decimal(12,0)"),
        "highest_peak": F.max(r.peak_count),
        "mean_rating": F.avg(r.positive_pct).cast("decimal(5,2)"),
        "last_update": F.max(r.recorded_at),
        "new_today": F.count_if(F.col(r.created_at).cast("date") == today),
    }


def _summary_rows(t: Tables, last_rows: DataFrame | None) -> DataFrame:
    r = t.roles
    return (
        t.entity.select(r.entity_id, r.created_at)
        .join(_newest(t, last_rows), r.entity_id, "left")
        .join(t.rating.select(r.entity_id, r.rating_id, r.positive_pct), r.entity_id, "left")
    )


def summary(t: Tables, report_day=None, last_rows: DataFrame | None = None) -> DataFrame:
    """One row of totals. The day only labels the row and counts the new entities."""
    today = scalars.day(report_day)
    totals = _summary_rows(t, last_rows).agg(*[c.alias(n) for n, c in _figures(t, today).items()])
    return totals.select(today.alias("report_day"), *totals.columns)


def stats(t: Tables, report_day=None) -> DataFrame:
    """The summary without day and peak."""
    wanted = {n: c for n, c in _figures(t, scalars.day(report_day)).items() if n != "highest_peak"}
    return _summary_rows(t, None).agg(*[c.alias(n) for n, c in wanted.items()])


def _top_current(t: Tables, k: int, last_rows: DataFrame | None) -> DataFrame:
    """The k entities with the highest current count; names and ratings are looked up for those only."""
    r = t.roles
    known = _newest(t, last_rows).join(t.entity.select(r.entity_id), r.entity_id, "left_semi")
    top = top_k(known, k, *_by_current(t)).withColumnRenamed(r.recorded_at, "last_reading")
    return (
        top.join(t.entity.select(r.entity_id, r.external_id, r.name, r.maker, r.price), r.entity_id)
        .join(t.rating.select(r.entity_id, r.positive_pct, r.label), r.entity_id, "left")
    )


def _by_current(t: Tables) -> list[Column]:
    return [F.desc(t.roles.current_count), F.asc(t.roles.entity_id)]


def report_top_now(t: Tables, k: int = 5, last_rows: DataFrame | None = None) -> DataFrame:
    """Entities with the highest current count."""
    r = t.roles
    return _top_current(t, k, last_rows).orderBy(*_by_current(t)).select(
        r.name, r.maker, r.current_count, r.peak_count, r.price, r.positive_pct, r.label, "last_reading"
    )


def top_now(t: Tables, k: int = 10) -> DataFrame:
    """The same list with the external id and a position number."""
    r = t.roles
    return with_position(_top_current(t, k, None), _by_current(t)).select(
        "position", r.name, r.external_id, r.maker, r.price, r.current_count, r.peak_count,
        r.positive_pct, r.label, "last_reading",
    )


def report_top_categories(t: Tables, k: int = 10) -> DataFrame:
    """Categories with most entities; unlike ``by_category`` only those that have any."""
    r = t.roles
    named = category_figures(t, "inner").join(t.category.select(r.category_id, r.category_name), r.category_id)
    return top_k(named, k, F.desc("entities"), F.asc(r.category_id)).select(
        r.category_name, "entities", "mean_rating", "mean_price"
    )


def movers(t: Tables, k: int = 5, last_rows: DataFrame | None = None) -> DataFrame:
    """Entities whose count changed most between their last two readings."""
    r = t.roles
    rows = _last_rows(t, 2) if last_rows is None else last_rows
    pairs = pair_up(rows, r.entity_id, [r.current_count, r.recorded_at])
    now, then = F.col(r.current_count), F.col(f"previous_{r.current_count}")
    order = [F.abs(now - then).desc(), F.asc(r.entity_id)]
    top = top_k(pairs.join(t.entity.select(r.entity_id), r.entity_id, "left_semi"), k, *order)
    return top.join(t.entity.select(r.entity_id, r.name), r.entity_id).orderBy(*order).select(
        r.name,
        now.alias("count_now"),
        then.alias("count_before"),
        (now - then).alias("change"),
        scalars.percent_change(now, then).alias("change_pct"),
        F.col(r.recorded_at).alias("reading_now"),
        F.col(f"previous_{r.recorded_at}").alias("reading_before"),
    )


@dataclass(frozen=True)
class DailyReport:
    """Four result tables over one stored reduction of the snapshots."""

    summary: DataFrame
    top_now: DataFrame
    top_categories: DataFrame
    movers: DataFrame


def daily_report(t: Tables, report_day=None) -> DailyReport:
    """All parts of the report.

    The snapshots are read once: at most two rows per entity are written to the
    shared checkpoint folder, and three of the parts start from those.
    """
    ensure_checkpoint_dir(t.snapshot.sparkSession)
    last_rows = _last_rows(t, 2).checkpoint()
    return DailyReport(
        summary=summary(t, report_day, last_rows),
        top_now=report_top_now(t, 5, last_rows),
        top_categories=report_top_categories(t, 10),
        movers=movers(t, 5, last_rows),
    )
