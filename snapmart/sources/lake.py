"""A catalogue as partitioned Parquet folders, written by Spark's own writer and nothing else.

Keyed tables are hashed into buckets: ``<table>/bucket=<b>``. A batch reads the buckets it touches and writes
them anew with dynamic partition overwrite. Series grow by batches: ``<table>/<day or other folder>/batch=<name>``.

Every write can be repeated. A batch has a name that is the same when it runs again; what it adds to a series
takes the place of what it added before, and the keyed tables say in ``added_in`` which batch brought a row, so
that a batch that runs again sees the tables without its own rows and numbers them as the first time. A lake has
one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart import schema as S
from snapmart.session import ensure_checkpoint_dir

BATCH, BUCKET, ADDED_IN = "batch", "bucket", "added_in"


@dataclass(frozen=True)
class Keyed:
    schema: T.StructType
    key: str
    buckets: int = 64
    # whether a checksum of every bucket is kept beside the table, see ``digests``
    digested: bool = False
    # a whole number made of a row's columns that takes the place of the hashed bucket, such as its day
    place: Callable[[], Column] | None = None


@dataclass(frozen=True)
class Series:
    schema: T.StructType
    # folders above the batch: a column of the table, or a new date made by a function
    folders: Mapping[str, Callable[[], Column]] = field(default_factory=dict)


def layout(buckets: int = 64) -> dict[str, Keyed | Series]:
    """The tables of a catalogue. A bucket should hold some hundred megabytes."""
    # no folder of the log depends on the time of writing, or a batch that runs again would leave its first rows behind
    by_table = {"table_name": lambda: F.col("table_name")}
    return {
        "entity": Keyed(S.ENTITY, "external_id", buckets),
        "category": Series(S.CATEGORY),
        "bridge": Keyed(S.BRIDGE, "entity_id", buckets),
        "snapshot": Series(S.SNAPSHOT, {"recorded_date": lambda: F.col("recorded_at").cast("date")}),
        "rating": Keyed(S.RATING, "entity_id", buckets),
        "audit": Series(S.AUDIT, by_table),
        "audit_row": Series(S.AUDIT_ROW, by_table),
        "quarantine": Series(S.QUARANTINE),
    }


class Lake:
    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, Keyed | Series] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = dict(layout() if tables is None else tables)

    def read(self, table: str) -> DataFrame:
        """The table; a series also has its folder columns, for filters that choose folders."""
        spec = self.tables[table]
        if isinstance(spec, Keyed):
            return self.rows(table).select(*spec.schema.fieldNames())
        return self.rows(table).drop(BATCH)

    def read_buckets(self, table: str, buckets: Sequence[int]) -> DataFrame:
        """Some buckets of a keyed table."""
        return self.rows(table, buckets).select(*self.tables[table].schema.fieldNames())

    def rows(self, table: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table with ADDED_IN or BATCH, of some buckets or of all; empty before the first write."""
        spec, path = self.tables[table], f"{self.root}/{table}"
        if isinstance(spec, Keyed):
            wanted = [*spec.schema.fields, T.StructField(ADDED_IN, T.StringType())]
            folders = [T.StructField(BUCKET, T.IntegerType())]
        else:
            wanted = [*spec.schema.fields, *self._dates(spec), T.StructField(BATCH, T.StringType())]
            folders = []
        stored = T.StructType([T.StructField(f.name, f.dataType) for f in [*wanted, *folders]])
        try:
            found = self.spark.read.schema(stored).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], T.StructType(stored.fields[:len(wanted)]))
        if isinstance(spec, Keyed):
            # a bucket that lost its last row holds a row without a key
            found = found.where(F.col(spec.key).isNotNull())
            if buckets is not None:
                found = found.where(F.col(BUCKET).isin(*buckets))
        return found.select(*[f.name for f in wanted])

    def earlier(self, table: str, batch: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """``rows`` without those that this batch brought when it ran before."""
        mark = ADDED_IN if isinstance(self.tables[table], Keyed) else BATCH
        return self.rows(table, buckets).where(F.col(mark).isNull() | (F.col(mark) != batch))

    def highest(self, columns: Mapping[str, str], batch: str) -> dict[str, int]:
        """For each table the highest number in a column but for those of this batch, 0 if there is none; one job."""
        found = [self.earlier(t, batch).agg(F.max(c).cast("long").alias("m")).select(F.lit(t).alias("t"), "m")
                 for t, c in columns.items()]
        return {r["t"]: r["m"] or 0 for r in reduce(DataFrame.unionByName, found).collect()}

    def keep(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` worked out once and read back, whatever happens to what they came from.

        They lie in columns beside the tables, so what uses a few of them reads no more. The next batch that keeps
        rows by this name takes their place.
        """
        path = f"{self.root}/kept_rows/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def touched(self, table: str, changes: DataFrame) -> list[int]:
        """Buckets that hold the keys of ``changes``: at most the number of buckets."""
        return sorted(r[BUCKET] for r in changes.select(self.bucket_of(table).alias(BUCKET)).distinct().collect())

    def bucket_of(self, table: str) -> Column:
        spec = self.tables[table]
        return (F.pmod(F.xxhash64(spec.key), F.lit(spec.buckets)) if spec.place is None else spec.place()).cast("int")

    def rewrite(self, table: str, rows: DataFrame, buckets: Sequence[int] | None = None) -> None:
        """New content of some buckets, or of all.

        ``rows`` may come from the table itself: the new files are put in place when all of them are written. What
        was read from the table before must not be used again, since it would be read anew. Rows without ADDED_IN get none. A bucket without rows gets one row without a key, since only folders that
        are written are overwritten.
        """
        spec = self.tables[table]
        named = rows if ADDED_IN in rows.columns else rows.withColumn(ADDED_IN, F.lit(None).cast("string"))
        placed = _conformed(named, spec.schema, ADDED_IN).withColumn(BUCKET, self.bucket_of(table))
        if buckets is None and spec.place is not None:
            raise ValueError(f"{table} has no fixed buckets: name those to write")
        numbers = self.spark.createDataFrame([(b,) for b in (range(spec.buckets) if buckets is None else buckets)], f"{BUCKET} int")
        marks = numbers.select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields], F.lit(None).cast("string").alias(ADDED_IN), BUCKET)
        dealt = placed.unionByName(marks).hint("rebalance", BUCKET)
        if spec.digested:
            # used twice
            ensure_checkpoint_dir(self.spark)
            dealt = dealt.checkpoint()
        self._write(table, dealt, [BUCKET])
        if spec.digested:
            self._write(f"{table}_digest", self._checksums(table, dealt), [BUCKET])

    def digests(self, table: str) -> DataFrame:
        """``bucket, rows, checksum`` of every bucket; read beside the table if it is ``digested``, else worked out.

        The checksum does not depend on the order of the rows, nor on the batch that brought them.
        """
        spec = self.tables[table]
        if not spec.digested:
            return self._checksums(table, self.rows(table).withColumn(BUCKET, self.bucket_of(table)))
        try:
            found = self.spark.read.schema(f"rows long, checksum decimal(38,0), {BUCKET} int").parquet(f"{self.root}/{table}_digest")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{BUCKET} int, rows long, checksum decimal(38,0)")
        return found.select(BUCKET, "rows", "checksum")

    def _checksums(self, table: str, placed: DataFrame) -> DataFrame:
        spec = self.tables[table]
        there = F.col(spec.key).isNotNull()
        # two hashes of 64 bits, so that a row that is there twice does not hide another; null differs from empty
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in spec.schema.fieldNames()]
        both = [F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)") for seed in (1, 2)]
        mixed = both[0] * F.lit(2 ** 31).cast("decimal(11,0)") + both[1]
        return placed.groupBy(BUCKET).agg(
            F.count_if(there).alias("rows"),
            F.coalesce(F.sum(F.when(there, mixed.cast("decimal(38,0)"))), F.lit(0)).cast("decimal(38,0)").alias("checksum"))

    def add(self, table: str, rows: DataFrame, batch: str) -> None:
        """Add a batch to a series; what the batch added to the same folders before goes."""
        self._write(table, self._with_folders(table, rows, batch), [*self.tables[table].folders, BATCH])

    def replace(self, table: str, rows: DataFrame, batch: str) -> None:
        """``rows`` in place of all that was there; they must not come from the table."""
        if isinstance(self.tables[table], Keyed):
            self.rewrite(table, rows)
        else:
            folders = [*self.tables[table].folders, BATCH]
            self._with_folders(table, rows, batch).write.mode("overwrite").partitionBy(*folders).parquet(f"{self.root}/{table}")

    def _with_folders(self, table: str, rows: DataFrame, batch: str) -> DataFrame:
        spec = self.tables[table]
        placed = _conformed(rows, spec.schema).withColumns({c: make() for c, make in spec.folders.items()})
        return placed.withColumn(BATCH, F.lit(batch))

    def _write(self, table: str, rows: DataFrame, folders: list[str]) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(f"{self.root}/{table}")

    @staticmethod
    def _dates(spec: Series) -> list[T.StructField]:
        return [T.StructField(c, T.DateType()) for c in spec.folders if c not in spec.schema.fieldNames()]


def _conformed(rows: DataFrame, wanted: T.StructType, *more: str) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields], *more)
