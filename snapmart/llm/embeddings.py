"""Near-duplicate vectors by binary codes of random rotations.

Unit vectors are rotated at random and their signs kept as code. For the first rotation a factor is
stored too: the inner product of the vector with its own code. Code times vector divided by that
factor is an unbiased estimate of the cosine, and its spread is known; pairs whose estimate is further
below the threshold than a wide confidence bound are ruled out, the others are worked out again exactly
in double precision.

Only vectors that share a bucket in one of many tables are compared, where a bucket is a run of code
bits; the number of tables follows from how rarely a pair at the threshold may be missed. A first pass over
the codes alone finds the vectors with a near code in a bucket; only those are sent on with all
coordinates. Large buckets are cut into blocks and all pairs of blocks become groups of their own. A
pair is counted in the first table in which it meets, inside the task; pairs never leave it.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import kept_in_shared_folder
from snapmart.llm.components import components

THRESHOLD = 0.9
# A pair just at the threshold shares no bucket with at most this probability.
MISSED = 1e-4
# Vectors that share a bucket by chance, about.
BUCKET_ROWS = 64
BLOCK_ROWS = 1024
# Widths of the confidence bounds in standard deviations.
ESTIMATE_SIGMAS = 5.0
CODE_SIGMAS = 6.0

_PAIRS_AT_ONCE = 100_000
_KEY_BITS = 40
_PART_BITS = 24


def plan_tables(vectors: int, threshold: float = THRESHOLD, missed: float = MISSED) -> tuple[int, int]:
    """Bits per bucket and number of tables for so many vectors."""
    bits = min(_KEY_BITS, max(2, math.ceil(math.log2(max(vectors, 1) / BUCKET_ROWS + 1))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(missed) / math.log(1 - same)))


@lru_cache(maxsize=8)
def rotations(size: int, bits: int) -> np.ndarray:
    """At least ``bits`` rows: random rotations of ``size`` dimensions, one below the other."""
    draw = np.random.default_rng([size, 20240])
    found = []
    for _ in range(-(-bits // size)):
        q, r = np.linalg.qr(draw.standard_normal((size, size)))
        found.append((q * np.sign(np.diag(r))).T)
    return np.vstack(found)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def table_keys(signs: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The bucket of each row in each table, from 0/1 code bits."""
    powers = 1 << np.arange(bits, dtype=np.int64)
    return np.stack([signs[:, t * bits:(t + 1) * bits] @ powers for t in range(tables)], axis=1)


def usable(embedding: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    return F.coalesce(
        embedding.isNotNull() & (F.size(embedding) > 0)
        & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _codes(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """``node, size, code, factor, buckets`` of distinct vectors."""
    def run(batches):
        for batch in batches:
            nodes, lists = batch.column(0), batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
                turned = unit(flat.reshape(len(rows), size)) @ rotations(size, max(bits * tables, size)).T
                signs = (turned > 0).astype(np.int64)
                factor = np.abs(turned[:, :size]).sum(axis=1) / math.sqrt(size)
                keys = table_keys(signs, bits, tables) | (np.arange(tables, dtype=np.int64) << _KEY_BITS)
                code = [row.tobytes() for row in np.packbits(signs.astype(np.uint8), axis=1, bitorder="little")]
                yield pa.RecordBatch.from_arrays([
                    nodes.take(pa.array(rows)), pa.array(np.full(len(rows), size, np.int32)), pa.array(code, pa.binary()),
                    pa.array(factor), pa.array(list(keys), pa.list_(pa.int64()))],
                    names=["node", "size", "code", "factor", "buckets"])

    return vectors.select("node", "embedding").mapInArrow(
        run, "node string, size int, code binary, factor double, buckets array<long>")


def _dealt(rows: DataFrame) -> DataFrame:
    """A row for each bucket and pair of blocks that a vector takes part in; buckets of one go."""
    each = rows.withColumn("bucket", F.explode("buckets")).drop("buckets")
    sizes = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1")
    blocks = F.ceil(F.col("__rows") / BLOCK_ROWS).cast("long")
    return (
        each.join(sizes, "bucket")
        .withColumn("part", F.pmod(F.xxhash64("node"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("pair", F.shiftleft(F.least("part", "other"), _PART_BITS) + F.greatest("part", "other"))
        .drop("__rows", "other")
    )


def _by_group(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(table)`` for the rows of each bucket and pair of blocks, at most 2 x BLOCK_ROWS or so."""
    dealt = _dealt(rows).repartition("bucket", "pair").sortWithinPartitions("bucket", "pair")
    bucket, pair = dealt.columns.index("bucket"), dealt.columns.index("pair")

    def run(batches):
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(bucket).to_numpy(), batch.column(pair).to_numpy()])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                key = tuple(keys[start])
                if last is not None and key != last:
                    yield from work(pa.Table.from_batches(held))
                    held = []
                last = key
                held.append(batch.slice(start, end - start))
        if held:
            yield from work(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, schema)


def _facing(table: pa.Table) -> np.ndarray:
    """Which pairs this group has to judge: all of one block, or those across two; upper half only."""
    part = table.column("part").to_numpy()
    size = table.column("size").to_numpy()
    across = part[:, None] != part if part.min() != part.max() else np.ones((len(part), len(part)), bool)
    return np.triu(across & (size[:, None] == size), 1)


def _signs(table: pa.Table, bits: int) -> np.ndarray:
    """Code bits; codes are padded with zeros to one length, as sizes may differ."""
    codes = table.column("code").to_pylist()
    width = max(map(len, codes))
    raw = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in codes), np.uint8).reshape(len(codes), width)
    return np.unpackbits(raw, axis=1, bitorder="little")[:, :max(bits, 1)]


def _near_codes(bits: int, threshold: float):
    """Vectors with another in the group whose code is near; the bits are those of all tables."""
    differ = math.acos(threshold) / math.pi
    limit = bits * differ + CODE_SIGMAS * math.sqrt(bits * differ * (1 - differ))

    def work(table: pa.Table):
        sign = _signs(table, bits).astype(np.float32) * 2 - 1
        near = (((bits - sign @ sign.T) / 2 <= limit) & _facing(table))
        found = np.flatnonzero(near.any(axis=0) | near.any(axis=1))
        if len(found):
            yield pa.RecordBatch.from_arrays([table.column("node").take(pa.array(found)).combine_chunks()], names=["node"])

    return work


def smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(bits: int, tables: int, threshold: float):
    """``node, root, links`` of every vector linked in the group; a pair only in its first table."""
    def work(table: pa.Table):
        n = table.num_rows
        face, size = _facing(table), table.column("size").to_numpy()
        lists = table.column("embedding").combine_chunks()
        number = int(table.column("bucket")[0].as_py()) >> _KEY_BITS
        keys = table_keys(_signs(table, bits * tables).astype(np.int64), bits, tables)
        copies, factors = table.column("copies").to_numpy(), table.column("factor").to_numpy()
        firsts, seconds = [], []
        for d in np.unique(size).tolist():
            rows = np.flatnonzero(size == d)
            vectors = unit(lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), d))
            turned = vectors @ rotations(d, max(bits * tables, d))[:d].T
            estimate = (np.where(turned > 0, 1.0, -1.0) / math.sqrt(d)) @ turned.T / factors[rows][:, None]
            spread = np.sqrt(np.maximum(0, 1 - factors[rows] ** 2) / factors[rows] ** 2 / max(d - 1, 1))
            bound = ESTIMATE_SIGMAS * spread if d > 8 else np.full(len(rows), 4.0)
            a, b = np.nonzero((estimate + bound[:, None] >= threshold) & face[np.ix_(rows, rows)])
            for at in range(0, len(a), _PAIRS_AT_ONCE):
                x, y = a[at:at + _PAIRS_AT_ONCE], b[at:at + _PAIRS_AT_ONCE]
                link = np.einsum("ij,ij->i", vectors[x], vectors[y]) >= threshold
                x, y = rows[x[link]], rows[y[link]]
                new = ~(keys[x, :number] == keys[y, :number]).any(axis=1)
                firsts.append(x[new])
                seconds.append(y[new])
        a, b = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (firsts, seconds))
        if len(a):
            links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
            root, nodes = smallest_reachable(n, a, b), table.column("node")
            found = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [nodes.take(pa.array(found)).combine_chunks(), nodes.take(pa.array(root[found])).combine_chunks(),
                 pa.array(links[found].astype(np.int64))], names=["node", "root", "links"])

    return work


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, missed: float = MISSED, vec_id: str = "vec_id",
                    embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df``.

    Two rows are linked if the cosine of their vectors is ``threshold`` or more. Rows with a null or
    zero vector, or with null or non-finite components, have no links and are kept; so are vectors of
    different lengths unlinked. Equal vectors are one node with so many copies, each linked to all
    others. ``component_id`` is the smallest vec_id that can be reached; null ids are passed over. A row is
    kept if it bears that id. A pair below 0.9999 of all at the threshold may be missed, see ``MISSED``;
    none below the threshold is ever linked. No rows give no rows.
    """
    values = F.transform(F.col(embedding), lambda x: x.cast("double") + F.lit(0.0))
    good = usable(F.col(embedding))
    rows = df.select(F.col(vec_id).alias("vec_id"), F.when(good, values).alias("embedding")).withColumn(
        "node", F.md5(F.array_join(F.col("embedding").cast("array<string>"), ",")))
    vectors = kept_in_shared_folder(
        rows.where(F.col("node").isNotNull()).groupBy("node", "embedding")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id")))
    bits, tables = plan_tables(vectors.count(), threshold, missed)
    codes = kept_in_shared_folder(_codes(vectors, bits, tables))
    near = _by_group(codes.drop("factor"), _near_codes(bits * tables, threshold), "node string").distinct()
    chosen = codes.join(near, "node", "left_semi").join(vectors.select("node", "embedding", "copies"), "node")
    found = kept_in_shared_folder(
        _by_group(chosen, _links(bits, tables, threshold), "node string, root string, links long"))
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = (
        vectors.select("node", "copies", "least_id").join(counts, "node", "left").join(linked, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    ids = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = classes.join(ids, "root").select(
        "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    return rows.select("vec_id", "node").join(named, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
