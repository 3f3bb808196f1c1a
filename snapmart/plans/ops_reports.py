"""Reports on runs and schedules kept as ordinary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import scalars

# Codes of runs and schedules and their texts.
RUN_KINDS = {"D": "FULL", "I": "DIFERENCIAL", "L": "LOG"}
FREQUENCIES = {4: "Diario", 8: "Semanal"}
ONCE, EVERY_MINUTES, EVERY_HOURS = 1, 4, 8
ONCE_TEXT, EVERY_TEXT, MINUTES_TEXT, HOURS_TEXT, UNKNOWN_TEXT = "Una vez", "Cada ", " min", " h", "?"


def run_history(runs: DataFrame, files: DataFrame, database: str, k: int = 20) -> DataFrame:
    """The newest runs of a database with kind, seconds, megabytes and file."""
    newest = (
        runs.where(F.col("database_name") == database).join(files, "run_id")
        .orderBy(F.desc("started"), F.asc("run_id"), F.asc("file")).limit(k)
    )
    return newest.select(
        "run_id", "database_name",
        scalars.decode("kind", RUN_KINDS).alias("kind"),
        "started", "finished",
        scalars.boundaries_between("SECOND", "started", "finished").alias("seconds"),
        scalars.megabytes("bytes").alias("size_mb"),
        scalars.compact_stamp("started").alias("stamp"),
        "file",
    )


def _sub_frequency(default: str):
    every = F.concat(F.lit(EVERY_TEXT), F.col("subday_every").cast("string"))
    return (
        F.when(F.col("subday_type") == ONCE, ONCE_TEXT)
        .when(F.col("subday_type") == EVERY_MINUTES, F.concat(every, F.lit(MINUTES_TEXT)))
        .when(F.col("subday_type") == EVERY_HOURS, F.concat(every, F.lit(HOURS_TEXT)))
        .otherwise(default)
    )


def schedule_report(jobs: DataFrame, links: DataFrame, schedules: DataFrame, name_prefix: str,
                    collation: str | None = None) -> DataFrame:
    """Jobs whose name starts with a prefix, with their schedule in words."""
    return (
        jobs.where(scalars.begins_with("job_name", name_prefix, collation))
        .join(links, "job_id").join(schedules, "schedule_id")
        .select(
            "job_id", "job_name", "enabled", "schedule_name",
            scalars.decode("freq_type", FREQUENCIES, F.col("freq_type").cast("string")).alias("frequency"),
            _sub_frequency(UNKNOWN_TEXT).alias("sub_frequency"),
            scalars.clock_text("start_hhmmss").alias("starts_at"),
        )
    )


def job_schedule(jobs: DataFrame, links: DataFrame, schedules: DataFrame, job_name: str,
                 collation: str | None = None) -> DataFrame:
    """The schedules of one job; what is neither minutes nor hours counts as once."""
    return (
        jobs.where(scalars.same_text("job_name", job_name, collation))
        .join(links, "job_id").join(schedules, "schedule_id")
        .select("job_name", "schedule_name", _sub_frequency(ONCE_TEXT).alias("sub_frequency"), "schedule_enabled")
    )


def expired_runs(runs: DataFrame, days: int, as_of=None, started: str = "started") -> DataFrame:
    """Runs that began more than ``days`` days ago. Lists them, deletes nothing."""
    if days < 1:
        raise ValueError("days must be at least 1")
    return runs.where(F.col(started) < scalars.before(scalars.timestamp(as_of), days, "DAY"))
