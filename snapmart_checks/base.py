"""Registration of checks, and results in types both engines hand over alike."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import driver_tables

AS_OF = "2001-11-04 00:00:00"
REPORT_DAY = "1995-01-05"


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Check] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, dates as text, integers as bigint."""
    def one(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(f.name).cast("long").alias(f.name)
        return F.col(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def check(name: str, sql: str | None = None, roles: Sequence[str] = ()):
    """Register a function of (spark, sf_dir); ``sql`` may use the named roles as tables."""
    text = sql
    if sql is not None and roles:
        own = sql.strip()
        rest = f",\n{own[5:]}" if own.startswith("WITH ") else f"\n{sql}"
        text = "WITH " + ",\n".join(f"{r} AS ({driver_tables.role_sql(r)})" for r in roles) + rest

    def register(run):
        REGISTRY[name] = Check(lambda spark, sf_dir: plain(run(spark, sf_dir)), text)
        return run

    return register


def mean_sql(column: str) -> str:
    """Mean of a decimal with two places, rounded half up to six places and then to two."""
    cents = f"sum(CAST({column} * 100 AS HUGEINT))"
    rows = f"nullif(count({column}), 0)"
    six = f"((2 * {cents} * 10000 + {rows}) // (2 * {rows}))"
    return f"CAST(({six} + 5000) // 10000 AS DOUBLE) / 100.0"


def num(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS DOUBLE) AS {name or column.split('.')[-1]}"


def text(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS VARCHAR) AS {name or column.split('.')[-1]}"


def row_text(df: DataFrame, name: str) -> DataFrame:
    """``table_name, row``: every column of a row as text, in the order of the names."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(df.columns)]
    return df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *cells).alias("row"))


def row_text_sql(source: str, name: str, columns: Sequence[str]) -> str:
    """The same for a table or query; ``columns`` may hold expressions with AS."""
    named = sorted((c.rsplit(" AS ", 1)[-1].strip(), c.rsplit(" AS ", 1)[0]) for c in columns)
    cells = ", ".join(f"coalesce(CAST({e} AS VARCHAR), '~')" for _, e in named)
    return f"SELECT '{name}' AS table_name, concat_ws('|', {cells}) AS row FROM {source}"


# The columns of the roles that are compared as text.
ROLE_COLUMNS = {
    "entity": ["entity_id", "external_id", "name", "description", "price", "released", "maker", "publisher", "created_at",
               "updated_at"],
    "category": ["category_id", "category_name"],
    "bridge": ["entity_id", "category_id"],
    "snapshot": ["snapshot_id", "entity_id", "current_count", "peak_count", "total_ratings", "recorded_at"],
    "rating": ["rating_id", "entity_id", "positive", "negative", "positive_pct", "label"],
}


def json_sql(columns: Mapping[str, str]) -> str:
    """JSON text of a row without its null fields; the values say how a column is shown: n as a number, t as text."""
    def shown(name: str, kind: str) -> str:
        value = f"CAST({name} AS VARCHAR)" if kind == "n" else f"""concat('"', CAST({name} AS VARCHAR), '"')"""
        return f"""CASE WHEN {name} IS NOT NULL THEN concat('"{name.split('.')[-1]}":', {value}) END"""

    return "concat('{', concat_ws(',', " + ", ".join(shown(n, k) for n, k in columns.items()) + "), '}')"
