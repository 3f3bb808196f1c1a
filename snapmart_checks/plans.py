"""Checks of the named queries."""

from __future__ import annotations

from snapmart import driver_tables
from snapmart.driver_tables import role, tables
from snapmart.plans import catalog, ops_reports, reports
from snapmart_checks.base import REPORT_DAY, check, mean_sql, num, text

CATALOG = ("entity", "category", "bridge", "rating")
ALL = ("entity", "category", "bridge", "snapshot", "rating")
MOVING = ("entity", "snapshot", "rating")

LATEST = """latest AS (
    SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY entity_id
                   ORDER BY recorded_at DESC, snapshot_id DESC) AS rn FROM snapshot s) x WHERE rn <= 2)"""


def _with_latest(roles, body: str) -> str:
    ctes = ",\n".join(f"{r} AS ({driver_tables.role_sql(r)})" for r in roles)
    return f"WITH {ctes},\n{LATEST}\n{body}"


@check("top_entities", f"""
    SELECT e.entity_id, e.external_id, e.name, e.maker, e.publisher, {num('e.price')}, {text('e.released')},
           p.highest_peak, p.last_reading, c.categories, {num('r.positive_pct')}, r.label
    FROM entity e
    LEFT JOIN (SELECT entity_id, max(peak_count) AS highest_peak, max(recorded_at) AS last_reading
               FROM snapshot GROUP BY entity_id) p ON p.entity_id = e.entity_id
    LEFT JOIN (SELECT b.entity_id, string_agg(g.category_name, ', ' ORDER BY g.category_name) AS categories
               FROM bridge b JOIN category g ON g.category_id = b.category_id
               GROUP BY b.entity_id) c ON c.entity_id = e.entity_id
    LEFT JOIN rating r ON r.entity_id = e.entity_id""", ALL)
def _top_entities(spark, sf_dir):
    return catalog.top_entities(tables(spark, sf_dir))


_BY_CATEGORY = f"""
    SELECT g.category_id, g.category_name, count(b.entity_id) AS entities,
           {mean_sql('e.price')} AS mean_price, {mean_sql('r.positive_pct')} AS mean_rating,
           CAST(max(r.positive_pct) AS DOUBLE) AS best_rating
    FROM category g
    LEFT JOIN bridge b ON b.category_id = g.category_id
    LEFT JOIN entity e ON e.entity_id = b.entity_id
    LEFT JOIN rating r ON r.entity_id = e.entity_id
    GROUP BY g.category_id, g.category_name"""


@check("by_category", _BY_CATEGORY, CATALOG)
def _by_category(spark, sf_dir):
    return catalog.by_category(tables(spark, sf_dir, *CATALOG))


@check("top_categories", f"""
    SELECT category_name, entities, mean_price, mean_rating FROM ({_BY_CATEGORY}) v
    ORDER BY entities DESC, category_id LIMIT 10""", CATALOG)
def _top_categories(spark, sf_dir):
    return catalog.top_categories(tables(spark, sf_dir, *CATALOG))


@check("best_rated", f"""
    SELECT e.entity_id, e.name, e.maker, {num('e.price')}, {text('e.released')}, r.positive, r.negative,
           {num('r.positive_pct')}, r.label, r.positive + r.negative AS votes
    FROM entity e JOIN rating r ON r.entity_id = e.entity_id WHERE r.positive_pct > 90""", ("entity", "rating"))
def _best_rated(spark, sf_dir):
    return catalog.best_rated(tables(spark, sf_dir, "entity", "rating"), 90)


_PRICE_RANGE = f"""
    SELECT e.entity_id, e.external_id, e.name, {num('e.price')}, e.maker, e.publisher, {text('e.released')},
           {num('r.positive_pct')}, r.label
    FROM entity e LEFT JOIN rating r ON r.entity_id = e.entity_id
    WHERE e.price BETWEEN 905 AND 915"""


@check("by_price_range", _PRICE_RANGE, ("entity", "rating"))
def _by_price_range(spark, sf_dir):
    return catalog.by_price_range(tables(spark, sf_dir, "entity", "rating"), 905, 915)


@check("by_price_range_function", _PRICE_RANGE, ("entity", "rating"))
def _by_price_range_function(spark, sf_dir):
    catalog.register_sql(tables(spark, sf_dir), "shop_", ["by_price_range"])
    return spark.sql("SELECT * FROM shop_by_price_range(905, 915)")


_MIN_RATING = f"""
    SELECT e.entity_id, e.external_id, e.name, {num('e.price')}, e.maker, r.positive, r.negative,
           {num('r.positive_pct')}, r.label, r.positive + r.negative AS votes
    FROM entity e JOIN rating r ON r.entity_id = e.entity_id WHERE r.positive_pct >= 66.67"""


@check("by_min_rating", _MIN_RATING, ("entity", "rating"))
def _by_min_rating(spark, sf_dir):
    return catalog.by_min_rating(tables(spark, sf_dir, "entity", "rating"), "66.67")


@check("by_min_rating_function", _MIN_RATING, ("entity", "rating"))
def _by_min_rating_function(spark, sf_dir):
    catalog.register_sql(tables(spark, sf_dir), "shop_", ["by_min_rating"])
    return spark.sql("SELECT * FROM shop_by_min_rating(66.67)")


_HISTORY = """
    SELECT snapshot_id, recorded_at, current_count, peak_count, total_ratings,
           current_count - lag(current_count, 1, current_count) OVER w AS delta_current_count,
           peak_count - lag(peak_count, 1, peak_count) OVER w AS delta_peak_count,
           total_ratings - lag(total_ratings, 1, total_ratings) OVER w AS delta_total_ratings
    FROM snapshot WHERE entity_id = 3 WINDOW w AS (ORDER BY recorded_at, snapshot_id)"""


@check("entity_history", _HISTORY, ("snapshot",))
def _entity_history(spark, sf_dir):
    return catalog.entity_history(tables(spark, sf_dir, "snapshot"), 3)


@check("entity_history_function", _HISTORY, ("snapshot",))
def _entity_history_function(spark, sf_dir):
    catalog.register_sql(tables(spark, sf_dir), "shop_", ["entity_history"])
    return spark.sql("SELECT * FROM shop_entity_history(3)")


_FIGURES = f"""
    count(DISTINCT e.entity_id) AS entities, count(DISTINCT r.rating_id) AS rated_entities,
    CAST(sum(u.current_count) AS BIGINT) AS current_total,
    CAST(CAST(avg(CAST(u.current_count AS DOUBLE)) AS DECIMAL(12,0)) AS DOUBLE) AS current_mean,
    {mean_sql('r.positive_pct')} AS mean_rating, max(u.recorded_at) AS last_update,
    count(CASE WHEN CAST(e.created_at AS DATE) = DATE '{REPORT_DAY}' THEN 1 END) AS new_today"""
_FIGURES_FROM = """
    FROM entity e
    LEFT JOIN latest u ON u.entity_id = e.entity_id AND u.rn = 1
    LEFT JOIN rating r ON r.entity_id = e.entity_id"""


@check("report_summary", _with_latest(MOVING, f"""
    SELECT '{REPORT_DAY}' AS report_day, max(u.peak_count) AS highest_peak, {_FIGURES} {_FIGURES_FROM}"""))
def _report_summary(spark, sf_dir):
    return reports.summary(tables(spark, sf_dir, *MOVING), REPORT_DAY)


@check("stats", _with_latest(MOVING, f"SELECT {_FIGURES} {_FIGURES_FROM}"))
def _stats(spark, sf_dir):
    return reports.stats(tables(spark, sf_dir, *MOVING), REPORT_DAY)


@check("report_top_now", _with_latest(MOVING, f"""
    SELECT e.name, e.maker, u.current_count, u.peak_count, {num('e.price')}, {num('r.positive_pct')}, r.label,
           u.recorded_at AS last_reading
    FROM latest u JOIN entity e ON e.entity_id = u.entity_id LEFT JOIN rating r ON r.entity_id = e.entity_id
    WHERE u.rn = 1 ORDER BY u.current_count DESC, e.entity_id LIMIT 5"""))
def _report_top_now(spark, sf_dir):
    return reports.report_top_now(tables(spark, sf_dir, *MOVING))


@check("top_now", _with_latest(MOVING, f"""
    SELECT row_number() OVER (ORDER BY current_count DESC, entity_id) AS position, name, external_id, maker,
           {num('price')}, current_count, peak_count, {num('positive_pct')}, label, recorded_at AS last_reading
    FROM (SELECT e.entity_id, e.name, e.external_id, e.maker, e.price, u.current_count, u.peak_count,
                 r.positive_pct, r.label, u.recorded_at
          FROM latest u JOIN entity e ON e.entity_id = u.entity_id LEFT JOIN rating r ON r.entity_id = e.entity_id
          WHERE u.rn = 1 ORDER BY u.current_count DESC, e.entity_id LIMIT 10) v"""))
def _top_now(spark, sf_dir):
    return reports.top_now(tables(spark, sf_dir, *MOVING), 10)


@check("report_top_categories", f"""
    SELECT g.category_name, count(DISTINCT b.entity_id) AS entities,
           {mean_sql('r.positive_pct')} AS mean_rating, {mean_sql('e.price')} AS mean_price
    FROM category g JOIN bridge b ON b.category_id = g.category_id JOIN entity e ON e.entity_id = b.entity_id
    LEFT JOIN rating r ON r.entity_id = e.entity_id
    GROUP BY g.category_id, g.category_name ORDER BY entities DESC, g.category_id LIMIT 10""", CATALOG)
def _report_top_categories(spark, sf_dir):
    return reports.report_top_categories(tables(spark, sf_dir, *CATALOG))


@check("report_movers", _with_latest(("entity", "snapshot"), """
    SELECT e.name, a.current_count AS count_now, p.current_count AS count_before,
           a.current_count - p.current_count AS change,
           CAST(CAST((CAST(a.current_count - p.current_count AS DOUBLE) / nullif(p.current_count, 0)) * 100
                AS DECIMAL(8,1)) AS DOUBLE) AS change_pct,
           a.recorded_at AS reading_now, p.recorded_at AS reading_before
    FROM latest a JOIN latest p ON p.entity_id = a.entity_id AND p.rn = 2
    JOIN entity e ON e.entity_id = a.entity_id
    WHERE a.rn = 1 ORDER BY abs(a.current_count - p.current_count) DESC, e.entity_id LIMIT 5"""))
def _report_movers(spark, sf_dir):
    return reports.movers(tables(spark, sf_dir, "entity", "snapshot"))


@check("run_history", """
    SELECT run_id, database_name, CASE kind WHEN 'D' THEN 'FULL' WHEN 'I' THEN 'DIFERENCIAL' WHEN 'L' THEN 'LOG' END AS kind,
           started, finished, datediff('second', started, finished) AS seconds,
           CAST(CAST(bytes / 1048576.0 AS DECIMAL(12,2)) AS DOUBLE) AS size_mb,
           strftime(started, '%Y%m%d_%H%M%S') AS stamp, file
    FROM (SELECT r.*, f.file FROM run r JOIN run_file f ON f.run_id = r.run_id WHERE r.database_name = 'shop'
          ORDER BY started DESC, run_id, file LIMIT 20) v""", ("run", "run_file"))
def _run_history(spark, sf_dir):
    return ops_reports.run_history(role(spark, sf_dir, "run"), role(spark, sf_dir, "run_file"), "shop")


_SUB = """CASE subday_type WHEN 1 THEN 'Una vez'
               WHEN 4 THEN concat('Cada ', CAST(subday_every AS VARCHAR), ' min')
               WHEN 8 THEN concat('Cada ', CAST(subday_every AS VARCHAR), ' h') ELSE '{}' END AS sub_frequency"""
_JOBS = ("job", "job_schedule", "schedule")
_JOB_JOIN = """FROM job j JOIN job_schedule k ON k.job_id = j.job_id
    JOIN schedule s ON s.schedule_id = k.schedule_id"""


@check("schedule_report", f"""
    SELECT j.job_id, j.job_name, j.enabled, s.schedule_name,
           CASE freq_type WHEN 4 THEN 'Diario' WHEN 8 THEN 'Semanal' ELSE CAST(freq_type AS VARCHAR) END AS frequency,
           {_SUB.format('?')},
           concat(right(concat('0', CAST(start_hhmmss // 10000 AS VARCHAR)), 2), ':',
                  right(concat('0', CAST(start_hhmmss % 10000 // 100 AS VARCHAR)), 2)) AS starts_at
    {_JOB_JOIN} WHERE j.job_name LIKE 'Supplier#%'""", _JOBS)
def _schedule_report(spark, sf_dir):
    return ops_reports.schedule_report(*[role(spark, sf_dir, n) for n in _JOBS], "Supplier#")


@check("job_schedule", f"""
    SELECT j.job_name, s.schedule_name, {_SUB.format('Una vez')}, s.schedule_enabled
    {_JOB_JOIN} WHERE j.job_name = 'Supplier#000000003'""", _JOBS)
def _job_schedule(spark, sf_dir):
    return ops_reports.job_schedule(*[role(spark, sf_dir, n) for n in _JOBS], "Supplier#000000003")


@check("job_schedule_collated", f"""
    SELECT j.job_name, s.schedule_name, {_SUB.format('Una vez')}, s.schedule_enabled
    {_JOB_JOIN} WHERE j.job_name = 'Supplier#000000003'""", _JOBS)
def _job_schedule_collated(spark, sf_dir):
    """The name is asked for in other letters and with blanks behind it."""
    return ops_reports.job_schedule(*[role(spark, sf_dir, n) for n in _JOBS], "SÚPPLIER#000000003  ", "es_CI_AI_RTRIM")


@check("schedule_report_collated", """
    SELECT j.job_id, j.job_name, s.schedule_name FROM job j JOIN job_schedule k ON k.job_id = j.job_id
    JOIN schedule s ON s.schedule_id = k.schedule_id WHERE lower(j.job_name) LIKE 'supplier#%'""", _JOBS)
def _schedule_report_collated(spark, sf_dir):
    found = ops_reports.schedule_report(*[role(spark, sf_dir, n) for n in _JOBS], "sUPPLIÉR#", "es_CI_AI_RTRIM")
    return found.select("job_id", "job_name", "schedule_name")


@check("expired_runs", """
    SELECT run_id, database_name, kind, started, finished, bytes FROM run
    WHERE started < TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 7 DAY""", ("run",))
def _expired_runs(spark, sf_dir):
    return ops_reports.expired_runs(role(spark, sf_dir, "run"), 7, "1998-01-01 00:00:00")
