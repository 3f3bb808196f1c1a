"""Shards by a hierarchical weighted hash tree.

The tree has regions, racks in them and shards in those. A row draws once per level: each child gets
the draw ``-ln(u) / weight`` with ``u`` from a hash of the key and the child's path, and the row goes
down to the child with the smallest one. A child is so chosen with a probability in proportion to its
weight, and the draw of a child whose weight stays does not change. When a weight changes, rows move
only into or out of the subtrees on the path of that change. A shard that comes as a region of its
own (``grown``) takes rows only into itself.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import hash60, hash60_sql, running_totals

Tree = dict[str, dict[str, dict[int, float]]]

_HASH_RANGE = float(1 << 60)


def even_tree(shards: int = 8, racks_per_region: int = 2, shards_per_rack: int = 2) -> Tree:
    """Shards 0.. of weight 1, filled rack by rack and region by region."""
    tree: Tree = {}
    for shard in range(shards):
        rack = shard // shards_per_rack
        tree.setdefault(f"g{rack // racks_per_region}", {}).setdefault(f"r{rack}", {})[shard] = 1.0
    return tree


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    number = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return {**tree, f"g+{number}": {f"r+{number}": {number: weight}}}


def _weight(node) -> float:
    return float(node) if not isinstance(node, dict) else sum(_weight(child) for child in node.values())


def _positive(children: dict) -> dict:
    found = {name: child for name, child in children.items() if _weight(child) > 0}
    if not found:
        raise ValueError("a tree needs a shard with a weight above 0")
    return found


def _draw(key: Column, path: str, weight: float) -> Column:
    unit = (hash60(key, F.lit(path)).cast("double") + 0.5) / F.lit(_HASH_RANGE)
    return -F.log(unit) / F.lit(weight)


def _descend(key: Column, children: dict, path: str) -> Column:
    children = _positive(children)
    draws = {name: _draw(key, f"{path}/{name}", _weight(child)) for name, child in children.items()}
    below = {name: _descend(key, child, f"{path}/{name}") if isinstance(child, dict) else F.lit(int(name))
             for name, child in children.items()}
    return _least(list(draws.values()), list(below.values()))


def _least(draws: list[Column], values: list[Column]) -> Column:
    if len(draws) == 1:
        return values[0]
    rest = F.least(*draws[1:]) if len(draws) > 2 else draws[1]
    return F.when(draws[0] <= rest, values[0]).otherwise(_least(draws[1:], values[1:]))


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key. Null keys count as empty text and all go to one shard."""
    return _descend(key, tree, "").cast("int")


def shard_rows(df: DataFrame, tree: Tree, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's shard, its place in the shard, and its shard after one more was added.

    Returns ``<key>, size, text_crc32, law, shard, slot, grown_shard``; other columns of ``df`` are not
    read. A null text has no bytes and the checksum of the empty text; size is 1. Repeated rows each
    get a slot. Rows with one key go to one shard whatever their text. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).alias("__key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
    ).withColumn("shard", shard_of(F.col("__key"), tree))
    placed = running_totals(rows, "shard", ["__key", "text_crc32", "size"], "size")
    return placed.select(
        F.col("__key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("rows_before").cast("long").alias("slot"), shard_of(F.col("__key"), grown(tree)).alias("grown_shard"),
    )


def shard_sql(key: str, tree: Tree) -> str:
    """``shard_of`` for the SQL check."""
    def down(children: dict, path: str) -> str:
        children = _positive(children)
        below = {n: down(c, f"{path}/{n}") if isinstance(c, dict) else str(n) for n, c in children.items()}
        if len(below) == 1:
            return next(iter(below.values()))
        draws = {n: f"(-ln((CAST({hash60_sql(key, repr(f'{path}/{n}'))} AS DOUBLE) + 0.5) / {_HASH_RANGE!r})"
                    f" / {_weight(c)!r})" for n, c in children.items()}
        least = f"least({', '.join(draws.values())})"
        return "CASE " + " ".join(f"WHEN {draws[n]} = {least} THEN {below[n]}" for n in children) + " END"

    return down(tree, "")
