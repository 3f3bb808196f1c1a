"""Reading tables behind a key, and writing them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions import scalars
from snapmart.operators.filters import after_key

JDBC_BATCH = 500


@dataclass(frozen=True)
class Split:
    """Ranges of a number column, one task each; rows outside go to the first and the last."""

    column: str
    low: int
    high: int
    parts: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": str(self.low), "upperBound": str(self.high),
                "numPartitions": str(self.parts)}


def read_table(spark: SparkSession, source: str | Mapping[str, str], columns: Sequence[str] | None = None,
               key: str | None = None, min_key: int | None = None, split: Split | None = None) -> DataFrame:
    """A parquet path or JDBC options; columns and the key filter reach the source.

    ``split`` divides a database table among tasks; without it one task reads it all.
    """
    if isinstance(source, str):
        df = spark.read.parquet(source)
    else:
        df = spark.read.format("jdbc").options(**source, **(split.options() if split else {})).load()
    if key is not None and min_key is not None:
        df = after_key(df, key, min_key)
    return df.select(*columns) if columns else df


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that is filled while it is written."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def jdbc_options(url: str, table: str, batch_size: int = JDBC_BATCH, **more: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **more}


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "append") -> int:
    """Write in batches from every partition at once; returns the rows sent.

    ``overwrite`` empties the table but keeps its definition.
    """
    watched, seen = counted(df)
    watched.write.format("jdbc").options(truncate="true", **options).mode(mode).save()
    return seen.get["rows"]


def overwrite_tables(tables: Mapping[str, DataFrame], targets: Mapping[str, str], order: Sequence[str]) -> dict[str, int]:
    """Reload parquet tables, parents first as ``order`` names them; returns the rows per table."""
    written = {}
    for name in order:
        watched, seen = counted(tables[name], name)
        watched.write.mode("overwrite").parquet(targets[name])
        written[name] = seen.get["rows"]
    return written


def with_valid_peak(df: DataFrame, peak: str = "peak_count", current: str = "current_count") -> DataFrame:
    return df.withColumn(peak, F.greatest(peak, current))


def append_snapshots(df: DataFrame, path: str, recorded_at: str = "recorded_at", peak: str = "peak_count",
                     current: str = "current_count") -> int:
    """Append readings, one folder per day; the peak is raised to the count."""
    watched, seen = counted(with_valid_peak(df, peak, current))
    (
        watched.withColumn("recorded_date", F.col(recorded_at).cast("date"))
        .write.mode("append").partitionBy("recorded_date").parquet(path)
    )
    return seen.get["rows"]


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON text per row; timestamps in ISO form, decimals as numbers, nulls kept."""
    def plain(f: T.StructField):
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            return scalars.iso_text(f.name).alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        return F.col(f.name)

    row = F.struct(*[plain(f) for f in df.schema.fields])
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("row"))
