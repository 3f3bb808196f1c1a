"""Change audit: what a statement did to a table.

The log has a row for every row that a statement touched, with both images as
JSON and the fields that changed, and one header per statement, which is an
aggregate of those. It has the same form at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions import scalars
from snapmart.operators.skew import CHUNK, POSITION, range_chunks

_EMPTY_EQUALS_NULL = (T.StringType, T.DateType)


def _differs(new: Column, old: Column, kind: T.DataType, collation: str | None) -> Column:
    """Text and dates: null counts as ''. Other types: unknown, so not different, if either is null."""
    if isinstance(kind, _EMPTY_EQUALS_NULL):
        new, old = (F.coalesce(c.cast("string"), F.lit("")) for c in (new, old))
        if collation is not None and isinstance(kind, T.StringType):
            new, old = F.collate(new, collation), F.collate(old, collation)
    return F.coalesce(new != old, F.lit(False))


def image_join(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Both images side by side: ``key``, structs ``old`` and ``new``, null where a row is missing."""
    wanted = list(dict.fromkeys([key, *columns]))

    def image(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).alias(f"__{name}_key"), F.struct(*wanted).alias(name))

    return (
        image(before, "old").join(image(after, "new"), F.col("__old_key") == F.col("__new_key"), "full_outer")
        .select(F.coalesce("__new_key", "__old_key").alias(key), "old", "new")
    )


def _flags(df: DataFrame, tracked: Sequence[str], collation: str | None) -> dict[str, Column]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    return {
        c: both & _differs(F.col(f"new.{c}"), F.col(f"old.{c}"), kinds[c], collation) for c in tracked
    }


def changed_fields_long(before: DataFrame, after: DataFrame, key: str, tracked: Sequence[str],
                        collation: str | None = None) -> DataFrame:
    """One row per field that changed anywhere: ``field`` and ``rows_changed``.

    One aggregate over one join counts all fields; the counts are then turned
    into rows.
    """
    flags = _flags(after, tracked, collation)
    counts = image_join(before, after, key, tracked).agg(
        *[F.count_if(flag).alias(c) for c, flag in flags.items()]
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("rows_changed")) for c in tracked])
    return counts.select(F.inline(pairs)).where(F.col("rows_changed") > 0)


def batch_facts(before: DataFrame, after: DataFrame, key: str, tracked: Sequence[str],
                collation: str | None = None) -> DataFrame:
    """One row: ``rows_before``, ``rows_after``, ``operation``, ``changed_fields``.

    The operation is INSERT or DELETE if only one image has rows, otherwise
    UPDATE. ``changed_fields`` lists a field if any row differs, in the order of
    ``tracked``, and is null if none does.
    """
    flags = _flags(after, tracked, collation)
    totals = image_join(before, after, key, tracked).agg(
        F.count("old").alias("rows_before"), F.count("new").alias("rows_after"),
        *[F.coalesce(F.max(flag), F.lit(False)).alias(f"__{c}") for c, flag in flags.items()],
    )
    operation = (
        F.when((F.col("rows_after") > 0) & (F.col("rows_before") == 0), "INSERT")
        .when((F.col("rows_after") == 0) & (F.col("rows_before") > 0), "DELETE")
        .otherwise("UPDATE")
    )
    fields = scalars.json_array_of([(c, F.col(f"__{c}")) for c in tracked])
    return totals.select(
        "rows_before", "rows_after", operation.alias("operation"),
        F.when(operation == "UPDATE", fields).alias("changed_fields"),
    )


def changed_fields(before: DataFrame, after: DataFrame, key: str, tracked: Sequence[str],
                   collation: str | None = None) -> DataFrame:
    return batch_facts(before, after, key, tracked, collation).select("changed_fields")


def changed_rows(before: DataFrame, after: DataFrame, key: str, tracked: Sequence[str],
                 collation: str | None = None) -> DataFrame:
    """One row per inserted, deleted or changed key, with its changed fields."""
    flags = _flags(after, tracked, collation)
    operation = F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "DELETE").otherwise("UPDATE")
    return (
        image_join(before, after, key, tracked)
        .select(key, operation.alias("operation"), scalars.json_array_of(list(flags.items())).alias("changed_fields"))
        .where((F.col("operation") != "UPDATE") | F.col("changed_fields").isNotNull())
    )


def audit_rows(before: DataFrame, after: DataFrame, key: str, tracked: Sequence[str], table: str, database: str,
               as_of=None, user: str | None = None, columns: Sequence[str] | None = None,
               collation: str | None = None, audit_id: int = 1) -> DataFrame:
    """The touched rows of one statement: one row per key in either image.

    Both images come from one join. ``operation`` is that of the row,
    ``changed_fields`` the JSON list of its own changed fields, null if none
    differs. Null fields are left out of the JSON images; ``columns`` limits them.
    """
    shown = list(columns or after.columns)
    flags = _flags(after, tracked, collation)

    def document(side: str) -> Column:
        def shown_as(c: str) -> Column:
            # the writer's own format would cut microseconds
            moment = isinstance(after.schema[c].dataType, (T.TimestampNTZType, T.TimestampType))
            value = F.col(f"{side}.{c}")
            return (scalars.iso_text(value) if moment else value).alias(c)

        return F.when(F.col(side).isNotNull(), F.to_json(F.struct(*[shown_as(c) for c in shown])))

    operation = F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "DELETE").otherwise("UPDATE")
    return image_join(before, after, key, [*tracked, *shown]).select(
        F.lit(audit_id).cast("long").alias("audit_id"),
        F.lit(database).alias("database_name"),
        F.lit(table).alias("table_name"),
        scalars.timestamp(as_of).alias("logged_at"),
        (F.current_user() if user is None else F.lit(user)).alias("user_name"),
        F.col(key).cast("string").alias("row_key"),
        operation.alias("operation"),
        document("old").alias("before_row"),
        document("new").alias("after_row"),
        scalars.json_array_of(list(flags.items())).alias("changed_fields"),
    )


def audit_headers(rows: DataFrame, tracked: Sequence[str]) -> DataFrame:
    """One row per statement of ``audit_rows``; a statement that touched nothing has none.

    The operation is INSERT or DELETE if only one image has rows, otherwise
    UPDATE, and then ``changed_fields`` lists a field if it differs in any row, in
    the order of ``tracked``. Rows are combined in the map tasks.
    """
    changed = F.from_json("changed_fields", "array<string>")
    totals = rows.groupBy("audit_id", "database_name", "table_name", "logged_at", "user_name").agg(
        F.count("before_row").alias("rows_before"), F.count("after_row").alias("rows_after"),
        *[F.coalesce(F.max(F.array_contains(changed, c)), F.lit(False)).alias(f"__{c}") for c in tracked],
    )
    operation = (
        F.when(F.col("rows_before") == 0, "INSERT").when(F.col("rows_after") == 0, "DELETE").otherwise("UPDATE")
    )
    return totals.select(
        "audit_id", "database_name", "table_name", operation.alias("operation"), "logged_at", "user_name",
        "rows_before", "rows_after", scalars.json_array_of([(c, F.col(f"__{c}")) for c in tracked]).alias("changed_fields"))


# One statement, in the order its documents are laid out.
STATEMENT = ("audit_id", "database_name", "table_name", "logged_at", "user_name")


def statement_documents(rows: DataFrame, max_bytes: int = 16 * 1024 * 1024, chunks: int | None = None) -> DataFrame:
    """Each statement of ``audit_rows`` with its images as JSON arrays, in parts of a bounded size.

    Rows stand in the order of their keys, shorter keys first, so that numbers are in order. A part begins
    with the row before which ``max_bytes`` of images, or a further multiple of it, are full; a small statement is
    one part. ``before_rows`` and ``after_rows`` are null where a part has no such image. The columns are those
    of the statement, ``part`` counted from 1, ``rows_before``, ``rows_after``, and the two arrays.

    A statement of any size is cut over all tasks: rows are sorted in chunks, bytes are added up in each, and
    only the totals of the chunks are added up over the statement.
    """
    order = ["__width", "row_key"]
    images = rows.select(*STATEMENT, "row_key", "before_row", "after_row", F.length("row_key").alias("__width"), (
        F.coalesce(F.octet_length("before_row"), F.lit(0)) + F.coalesce(F.octet_length("after_row"), F.lit(0))).alias("__bytes"))
    chunked = range_chunks(images, [*STATEMENT, *order], chunks)
    totals = chunked.groupBy(*STATEMENT, CHUNK).agg(F.sum("__bytes").alias("__total"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"__{c}") for c in STATEMENT], F.col(CHUNK).alias("__at"), F.coalesce(
        F.sum("__total").over(_ordered(before, STATEMENT, [CHUNK])), F.lit(0)).alias("__offset"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in STATEMENT] + [F.col(CHUNK) == F.col("__at")]
    inside = F.coalesce(F.sum("__bytes").over(_ordered(before, [*STATEMENT, CHUNK], [POSITION])), F.lit(0))
    placed = chunked.withColumn("__inside", inside).join(offsets, same).withColumn(
        "part", F.floor((F.col("__offset") + F.col("__inside")) / max_bytes).cast("int"))

    def array(image: str) -> Column:
        given = F.collect_list(F.when(F.col(image).isNotNull(), F.struct(*order, F.col(image).alias("doc"))))
        docs = F.transform(F.array_sort(given), lambda r: r["doc"])
        return F.when(F.size(docs) > 0, F.concat(F.lit("["), F.array_join(docs, ","), F.lit("]")))

    parts = placed.groupBy(*STATEMENT, "part").agg(
        F.count("before_row").alias("rows_before"), F.count("after_row").alias("rows_after"),
        array("before_row").alias("before_rows"), array("after_row").alias("after_rows"))
    # a row longer than the limit leaves numbers out
    number = F.row_number().over(Window.partitionBy(*STATEMENT).orderBy("part")).alias("part")
    return parts.select(*STATEMENT, number, "rows_before", "rows_after", "before_rows", "after_rows")


def _ordered(frame, groups: Sequence[str], order: Sequence[str]):
    return frame.partitionBy(*groups).orderBy(*order)


def audit_tail(audit: DataFrame, n: int = 20) -> DataFrame:
    """The newest ``n`` log rows with the changed fields as plain text."""
    return (
        audit.select("audit_id", "database_name", "table_name", "operation", "logged_at", "user_name",
                     "changed_fields")
        .orderBy(F.desc("logged_at"), F.desc("audit_id")).limit(n)
        .withColumn("changed_text", scalars.listed("changed_fields"))
    )


def audit_lookup(audit: DataFrame, database: str | None = None, table: str | None = None,
                 user: str | None = None, since=None, until=None) -> DataFrame:
    """Log rows of a table or a user in a span of time; the end is not part of it.

    A stored log is laid out by table, so that filter chooses folders; batches are written one after the other, so
    the span of time skips files by their statistics.
    """
    found = audit
    for column, value in (("database_name", database), ("table_name", table), ("user_name", user)):
        if value is not None:
            found = found.where(F.col(column) == value)
    if since is not None:
        found = found.where(F.col("logged_at") >= scalars.timestamp(since))
    if until is not None:
        found = found.where(F.col("logged_at") < scalars.timestamp(until))
    return found
