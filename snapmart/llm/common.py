"""What several operators share: reading a table, word counts, hashes, running totals."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.session import ensure_checkpoint_dir

# Fixed value of the contract: a word is a run of anything but these white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# 60 bits of an md5 digest; the top 12 of them pick one of 4096 buckets.
_HEX_DIGITS = 15
_BUCKET_SHIFT = 48
# Equal rows are cut into pieces of so many, so that no task holds all copies of one.
_PIECE = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_in_shared_folder(df: DataFrame) -> DataFrame:
    """``df`` worked out once and read back from the folder in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 1000 rows, unless the session says otherwise.

    Texts are long: with Spark's 10,000 rows the buffers of the JVM and of the Python workers take
    hundreds of megabytes.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def hash60(*parts: Column) -> Column:
    """A number below 2**60 from md5; DuckDB gives the same. Null parts count as empty."""
    text = F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("long")


def hash60_sql(*parts: str) -> str:
    """The same number for the SQL check."""
    text = " || '/' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"CAST('0x' || substr(md5({text}), 1, {_HEX_DIGITS}) AS BIGINT)"


def running_totals(df: DataFrame, group: str, keys: Sequence[str], amount: str) -> DataFrame:
    """Every row of ``df`` with the rows and the amounts that come before it in its group.

    The order in a group is by a hash of ``keys``; it depends on the rows alone. Adds
    ``rows_before`` and ``amount_before``. Copies of a row (equal in all columns) are counted before
    the shuffle, cut into pieces of at most 4096 and dealt over buckets of the hash, so neither a
    large group nor a row with very many copies ends up in one task. A window never runs over more
    than a bucket, or over the 4096 bucket totals of a group. Null is a group like any other.
    """
    columns = list(df.columns)
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    pieces = (
        counted.withColumn("__piece", F.explode(F.sequence(F.lit(0), ((F.col("__n") - 1) / _PIECE).cast("int"))))
        .withColumn("__copies", F.least(F.lit(_PIECE), F.col("__n") - F.col("__piece") * _PIECE))
        .withColumn("__hash", hash60(*[F.col(k) for k in keys], F.col("__piece")))
        .withColumn("__bucket", F.shiftright("__hash", _BUCKET_SHIFT).cast("int"))
        .withColumn("__sum", F.col("__copies") * F.col(amount))
    )
    earlier = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy(group, "__bucket").agg(F.sum("__copies").alias("__rows"), F.sum("__sum").alias("__sum"))
    offsets = totals.select(
        F.col(group).alias("__group"), F.col("__bucket").alias("__at"),
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows_offset"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__sum_offset"),
    )
    inside = (
        Window.partitionBy(group, "__bucket").orderBy("__hash", *columns, "__piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        pieces.withColumn("__rows_in", F.coalesce(F.sum("__copies").over(inside), F.lit(0)))
        .withColumn("__sum_in", F.coalesce(F.sum("__sum").over(inside), F.lit(0)))
        .join(offsets, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__bucket") == F.col("__at")))
        .withColumn("__copy", F.explode(F.sequence(F.lit(0), (F.col("__copies") - 1).cast("int"))))
    )
    return placed.select(
        *columns,
        (F.col("__rows_offset") + F.col("__rows_in") + F.col("__copy")).alias("rows_before"),
        (F.col("__sum_offset") + F.col("__sum_in") + F.col("__copy") * F.col(amount)).alias("amount_before"),
    )


def digits_only(name: str) -> str:
    """A name that is safe in a column name."""
    return re.sub(r"\W", "_", name)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores before it until no column of ``df`` has that name."""
    while wanted.lower() in {c.lower() for c in df.columns}:
        wanted = "_" + wanted
    return wanted


def text_slices(batch, at: int, slice_chars: int):
    """``start, stop, texts`` of an Arrow batch, cut so that a slice has about ``slice_chars`` characters.

    A longer text comes alone and whole; its neighbours are not held as Python strings with it.
    """
    import pyarrow.compute as pc

    column = batch.column(at)
    sizes = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > slice_chars:
            yield start, i, column.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes), column.slice(start).to_pylist()


def map_texts(df: DataFrame, key: str, text: str, work, columns: str, slice_chars: int = 2_000_000) -> DataFrame:
    """``work`` over lists of texts inside tasks: ``key`` and the columns that it returns.

    ``work(texts)`` gets texts (null for null) and returns one list for each of ``columns``. Arrow
    batches are cut so that it sees about ``slice_chars`` characters at a time; a longer text comes
    alone and whole.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    small_batches(df.sparkSession)
    rows = df.select(F.col(key).alias(key), F.col(text).cast("string").alias("__text"))
    added = StructType.fromDDL(columns)
    schema = StructType([rows.schema[0], *added.fields])
    types = [to_arrow_type(f.dataType) for f in added.fields]

    def run(batches):
        for batch in batches:
            for start, stop, texts in text_slices(batch, 1, slice_chars):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start),
                     *[pa.array(v, type=kind) for v, kind in zip(work(texts), types)]], names=schema.names)

    return rows.mapInArrow(run, schema)
