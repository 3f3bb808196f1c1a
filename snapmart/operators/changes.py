"""Changes to tables as joins: upsert, merge, dimension keys, children, cascades.

Every function returns the complete new table; ``snapmart.sources.lake`` writes
it. No join names a strategy: a change set that is small compared with the table
is broadcast by Spark after its own size check, and then the table is not
shuffled at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.functions import scalars
from snapmart.operators.latest import newest_per_group, oldest_per_group
from snapmart.operators.skew import dense_ids

ACTION = "__action"
KEEP, UPDATE, INSERT = "keep", "update", "insert"


def first_by_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order_by``; a repeated key shrinks before the shuffle."""
    return oldest_per_group(source, keys, order_by)


def last_by_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order_by``; a repeated key shrinks before the shuffle."""
    return newest_per_group(source, keys, order_by)


def highest_id(df: DataFrame, id_col: str) -> int:
    return df.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
          id_col: str | None = None, as_of=None, created_col: str | None = None,
          updated_col: str | None = None, start_id: int | None = None) -> DataFrame:
    """Matched rows take ``update_cols`` from the source, others are inserted.

    A key that is twice in the source is an error (see ``last_by_key``). New rows
    get ``id_col`` counted on from the target, unless the source brings it.
    ``created_col`` is set on insert only, ``updated_col`` on both. The column
    ACTION tells what happened to each row.
    """
    moment = scalars.timestamp(as_of)
    stamped = {c for c in (created_col, updated_col) if c}
    columns = target.columns
    source = _one_per_key(source, keys)

    incoming = source.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(c).alias(f"__s_{c}") for c in update_cols],
        F.lit(True).alias("__hit"),
    )
    on_keys = [F.col(k) == F.col(f"__k_{k}") for k in keys]
    hit = F.coalesce("__hit", F.lit(False))

    def merged(c: str):
        if c in update_cols:
            return F.when(hit, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c)
        if c == updated_col:
            return F.when(hit, moment).otherwise(F.col(c)).alias(c)
        return F.col(c)

    kept = target.join(incoming, on_keys, "left").select(
        *[merged(c) for c in columns], F.when(hit, UPDATE).otherwise(KEEP).alias(ACTION)
    )

    # only the keys both sides hold: never more than the source
    known = target.select(*keys).join(source.select(*keys), list(keys), "left_semi")
    new = source.join(known, list(keys), "left_anti")
    if id_col is not None and id_col not in source.columns:
        first = highest_id(target, id_col) if start_id is None else start_id
        new = dense_ids(new, list(keys), id_col, first)
    types = {f.name: f.dataType for f in target.schema.fields}
    inserted = new.select(*[
        (moment if c in stamped else F.col(c) if c in new.columns else F.lit(None)).cast(types[c]).alias(c)
        for c in columns
    ], F.lit(INSERT).alias(ACTION))
    return kept.unionByName(inserted)


def _one_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` as it is; fails when it is read if a key is there twice.

    The window takes the order that the joins by these keys need as well.
    """
    twice = F.raise_error(F.lit(f"a key is twice in the source: {', '.join(keys)}")).cast("boolean")
    counted = source.withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return counted.where(F.when(F.col("__rows") > 1, twice).otherwise(F.lit(True))).drop("__rows")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str], as_of=None,
           id_col: str | None = None, created_col: str | None = None,
           updated_col: str | None = None) -> DataFrame:
    """``merge`` without the ACTION column."""
    return merge(target, source, keys, update_cols, id_col, as_of, created_col, updated_col).drop(ACTION)


def new_dimension_rows(dimension: DataFrame, names: DataFrame, id_col: str, name_col: str, max_length: int = 100,
                       collation: str | None = None, start_id: int | None = None) -> DataFrame:
    """Rows to add so that the dimension has every name, numbered on in name order.

    With a collation, names it holds equal are one; a new one is stored in its
    smallest spelling. Names are made distinct in the map tasks before anything
    is shuffled.
    """
    def folded(c: str):
        return F.col(c) if collation is None else F.collate(F.col(c), collation)

    cut = names.select(F.substring(name_col, 1, max_length).alias(name_col)).where(F.col(name_col).isNotNull())
    wanted = cut.groupBy(folded(name_col).alias("__folded")).agg(F.min(name_col).alias(name_col))
    present = dimension.select(folded(name_col).alias("__present"))
    new = wanted.join(present, F.col("__folded") == F.col("__present"), "left_anti").select(name_col)
    numbered = dense_ids(new, [name_col], id_col, highest_id(dimension, id_col) if start_id is None else start_id)
    types = {f.name: f.dataType for f in dimension.schema.fields}
    return numbered.select(*[
        (F.col(c) if c in (id_col, name_col) else F.lit(None)).cast(types[c]).alias(c) for c in dimension.columns
    ])


def ensure_dimension(dimension: DataFrame, names: DataFrame, id_col: str, name_col: str, max_length: int = 100,
                     collation: str | None = None) -> DataFrame:
    """The dimension with a row for every name."""
    return dimension.unionByName(new_dimension_rows(dimension, names, id_col, name_col, max_length, collation))


def replace_children(bridge: DataFrame, pairs: DataFrame, parent_key: str,
                     touched: DataFrame | None = None) -> DataFrame:
    """Children of the touched parents are replaced by ``pairs``, each pair once.

    ``touched`` names the parents; without it they are those in ``pairs``. A
    parent that is touched but has no pair keeps no child.
    """
    parents = (pairs if touched is None else touched).select(parent_key)
    others = bridge.join(parents, parent_key, "left_anti")
    return others.unionByName(pairs.select(*bridge.columns).distinct())


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    key: str


def cascade_delete(tables: Mapping[str, DataFrame], foreign_keys: Sequence[ForeignKey], root: str,
                   keys: DataFrame, key: str) -> dict[str, DataFrame]:
    """Delete rows of ``root`` by key, and then whatever refers to deleted rows.

    The keys are not made distinct and the rows of ``root`` are not looked up for
    them: each child meets a plain list of keys, which Spark broadcasts if it is
    small, and otherwise it can split a parent with very many children.
    """
    gone = {root: keys.select(key)}
    left = dict(tables)
    left[root] = tables[root].join(keys.select(key), key, "left_anti")
    for parent in parents_first(foreign_keys, root):
        for fk in (f for f in foreign_keys if f.parent == parent and parent in gone):
            deleted = gone[parent].select(F.col(fk.key).alias("__gone"))
            match = F.col(fk.column) == F.col("__gone")
            lost = left[fk.child].join(deleted, match, "left_semi")
            left[fk.child] = left[fk.child].join(deleted, match, "left_anti")
            gone[fk.child] = gone[fk.child].unionByName(lost) if fk.child in gone else lost
    return left


def parents_first(foreign_keys: Sequence[ForeignKey], root: str) -> list[str]:
    """The tables below ``root``, each behind all its parents; refuses tables that refer in a circle."""
    try:
        order = TopologicalSorter({f.child: {g.parent for g in foreign_keys if g.child == f.child}
                                   for f in foreign_keys}).static_order()
        tables = list(order)
    except CycleError as circle:
        raise ValueError(f"tables refer to each other in a circle: {circle.args[1]}") from None
    return tables if root in tables else [root]


def cascade_rekey(tables: Mapping[str, DataFrame], foreign_keys: Sequence[ForeignKey], root: str, key: str,
                  mapping: DataFrame) -> dict[str, DataFrame]:
    """Rewrite keys of ``root`` from ``old_key`` to ``new_key``, and every reference to them."""
    pairs = mapping.select(F.col("old_key").alias("__old"), F.col("new_key").alias("__new"))

    def rewritten(df: DataFrame, column: str) -> DataFrame:
        kind = df.schema[column].dataType
        return (
            df.join(pairs, F.col(column) == F.col("__old"), "left")
            .withColumn(column, F.coalesce("__new", column).cast(kind)).drop("__old", "__new")
        )

    parents_first(foreign_keys, root)
    result, todo = dict(tables), [(root, key)]
    result[root] = rewritten(tables[root], key)
    while todo:  # a rewritten column may itself be a key that others refer to
        parent, column = todo.pop(0)
        for fk in foreign_keys:
            if fk.parent == parent and fk.key == column:
                result[fk.child] = rewritten(result[fk.child], fk.column)
                todo.append((fk.child, fk.column))
    return result
