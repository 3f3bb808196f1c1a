"""Near-duplicates by SimHash, found by meeting in the middle.

Two fingerprints that differ in at most two bits have a number within one bit of both. So every
fingerprint emits itself and all numbers one bit away; what meets at one number is linked, because
all of it lies within one bit of that number. Who meets is folded into one word of bits per number
before and after the shuffle: bit i stands for the fingerprint that differs there. No pairs are formed:
those that meet are linked to the smallest of them.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import free_name, kept_in_shared_folder, map_texts
from snapmart.llm.components import components
from snapmart.session import shuffle_partitions

# Fixed values of the contract: XXH64 with this seed; three words; two bits.
SEED = 42
SHINGLE_WORDS = 3
RADIUS = 2


def shingles(text: str | None, size: int) -> list[bytes]:
    """Runs of ``size`` words, A-Z lower-cased; a shorter text is one run, one without words has none."""
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def hashes(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))


def majority(bits: np.ndarray) -> np.ndarray:
    """Bytes, lowest bit first, of the columns of ``bits`` that are set in over half the rows."""
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(bits), bitorder="little")


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """64 bits as a signed number; 0 for a text without words."""
    parts = shingles(text, size)
    if not parts:
        return 0
    bits = np.unpackbits(hashes(parts).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(majority(bits).view(np.int64)[0])


def meeting_links(keys: DataFrame, bits: int) -> DataFrame:
    """Links ``a, b`` between the distinct ``key`` values whose lowest ``bits`` differ in at most two.

    Higher bits must be equal. Of those that meet at a number each is linked to the smallest; together
    the links connect what differs by two bits or fewer, and nothing else.
    """
    masks = [0] + [(1 << b) - (1 << 64 if b == 63 else 0) for b in range(bits)]
    all_masks = F.array(*[F.lit(m).cast("long") for m in masks])
    parts = shuffle_partitions(keys.sparkSession)
    met = (
        # so few bytes become so many rows here that a partition of the usual size would be too long a task
        keys.repartition(parts, "key").select("key", F.explode(all_masks).alias("mask"))
        .select(F.col("key").bitwiseXOR(F.col("mask")).alias("middle"), "mask")
        # hardly two of a task meet, and no number has more rows than masks: nothing to combine before the shuffle
        .repartition(parts, "middle").groupBy("middle")
        .agg(F.bit_or("mask").alias("around"), F.max(F.col("mask") == 0).alias("itself"))
        .where(F.bit_count("around") + F.col("itself").cast("int") > 1)
    )
    there = F.filter(all_masks, lambda m: ((m == 0) & F.col("itself")) | (m.bitwiseAND(F.col("around")) != 0))
    members = F.transform(there, lambda m: m.bitwiseXOR(F.col("middle")))
    pairs = met.select(F.array_min(members).alias("a"), F.explode(members).alias("b")).where("a != b").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def hex16(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _roots(rows: DataFrame, least: Column) -> DataFrame:
    """``fp, root, least`` for the distinct fingerprints of ``rows``; ``least`` is an aggregate of each one's rows."""
    nodes = rows.groupBy("fp").agg(least.alias("least"))
    linked = components(meeting_links(nodes.select(F.col("fp").alias("key")), 64))
    return nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def fingerprint_groups(docs: DataFrame, size: int = SHINGLE_WORDS, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Rows are linked if their fingerprints differ in at most two bits; ``component_id`` is the smallest
    doc_id that can be reached. Null and empty texts have fingerprint 0 and are linked like any other.
    Equal fingerprints are one node of the graph, so copies never multiply. Null ids are passed over by
    the smallest id; a group of nulls alone has a null component. No rows give no rows.
    """
    rows = kept_in_shared_folder(map_texts(
        docs, doc_id, text, lambda texts: [[fingerprint(t, size) for t in texts]], "fp long"))
    roots = _roots(rows, F.min(doc_id))
    named = roots.join(roots.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return rows.join(named.select("fp", "component_id"), "fp").select(
        F.col(doc_id).alias("doc_id"), hex16(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, size: int = SHINGLE_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of ``fingerprint_groups``: the one with the smallest id.

    All columns stay, whatever their names. A null id counts as larger than any other. Of rows with equal
    ids the one with the smallest digest of its text stays, of rows equal in id and text any one. Null and
    empty texts share fingerprint 0 and so one group. An empty table stays empty.
    """
    id_name, digest_name = free_name(docs, "__id"), free_name(docs, "__digest")
    digest = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
    row = F.struct(F.col(doc_id).isNull().alias("unnamed"), F.col(doc_id).alias("id"), digest.alias("digest")).alias("row")
    rows = kept_in_shared_folder(map_texts(
        docs.select(row, F.col(text).alias("text")), "row", "text",
        lambda texts: [[fingerprint(t, size) for t in texts]], "fp long"))
    best = _roots(rows, F.min("row")).groupBy("root").agg(F.min("least").alias("best"))
    copies = rows.groupBy("row").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    kept = kept_in_shared_folder(
        best.join(copies, F.col("best").eqNullSafe(F.col("row")), "left")
        .select(F.col("best.id").alias(id_name), F.col("best.digest").alias(digest_name), F.col("copies").isNotNull().alias("repeated")))

    def of(some: DataFrame) -> DataFrame:
        same = docs[doc_id].eqNullSafe(F.col(id_name)) & (
            F.md5(F.coalesce(docs[text].cast("string"), F.lit(""))) == F.col(digest_name))
        return docs.join(some.select(id_name, digest_name), same, "left_semi")

    found, repeated = of(kept.where("NOT repeated")), kept.where("repeated")
    if not repeated.isEmpty():
        again = of(repeated)
        key = free_name(again, "__key")
        one = again.withColumn(key, F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))).dropDuplicates([doc_id, key])
        found = found.unionByName(one.drop(key))
    return found
