"""Hard negatives by the threshold algorithm over sorted lists.

Rows are dealt over blocks by a hash of their id; a block has one list of its rows per dimension, sorted by
the component. An anchor reads the lists from the end that its sign favours, in rounds of growing depth.
Rows met for the first time are scored by random access, in whole numbers. What no list has shown yet scores
at most the threshold: the sum of the anchor's components times those last read. A window of scores is done
when the threshold falls strictly below its kth score, or below its lower end.

Every anchor is asked of every block; that is a stated query set against all rows, in blocks. Anchors pass by a
block one after the other, so a task holds one block of a bounded number of rows and one batch of anchors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import kept_in_shared_folder

# Fixed values of the contract.
SCALE = 256
RELABEL_EVERY, RELABEL_MODULO = 7, 10
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 10
WINDOW_PERCENT = (30, 90)

# Rows of a block: two matrices of 4 bytes a component, 8 MB at 64 dimensions.
BLOCK_ROWS = 16_384
_FIRST_STEP = 32


class SortedLists:
    """Rows of a block with a list per dimension. ``ids`` ascend, so the earlier of two rows has the smaller id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.orders = np.ascontiguousarray(np.argsort(rows, axis=0, kind="stable").T.astype(np.int32))
        self._of_label: dict[int, SortedLists] = {}

    def of_label(self, label: int) -> SortedLists:
        if label not in self._of_label:
            at = np.flatnonzero(self.labels == label)
            self._of_label[label] = SortedLists(self.ids[at], self.labels[at], self.rows[at])
        return self._of_label[label]

    def best(self, anchor: np.ndarray, windows: Sequence[tuple[int, int]], k: int,
             wanted: Callable[[np.ndarray], np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window the ids and scores of its first ``k`` rows: higher scores first, then smaller ids.

        ``wanted`` tells which of some rows count. Whole lists are read only if no threshold closes a window.
        """
        n = len(self.ids)
        used = np.flatnonzero(anchor[:self.rows.shape[1]])
        # a shorter vector has zeros where it ends
        weights = np.zeros(self.rows.shape[1], np.int64)
        weights[used] = anchor[used]
        up, down = used[weights[used] > 0], used[weights[used] < 0]
        seen = np.zeros(n, bool)
        at, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        still, depth, step = [w for w in windows if w[0] <= w[1]], 0, _FIRST_STEP
        lowest, highest = min((w[0] for w in still), default=0), max((w[1] for w in still), default=0)
        while still and depth < n:
            until = min(n, depth + step)
            if len(used):
                met = np.concatenate([self.orders[up, n - until:n - depth].ravel(), self.orders[down, depth:until].ravel()])
                fresh = np.zeros(n, bool)
                fresh[met] = True
                fresh &= ~seen
                seen |= fresh
                new = np.flatnonzero(fresh)
                edge = (weights[up] * self.rows[self.orders[up, n - until], up]).sum() + (
                    weights[down] * self.rows[self.orders[down, until - 1], down]).sum()
            else:  # an anchor of zeros: every row scores 0
                new, edge, until = np.arange(n), 0, n
            found = self.rows[new].astype(np.int64) @ weights
            fits = wanted(new) & (found >= lowest) & (found <= highest)
            at, scores = np.concatenate([at, new[fits]]), np.concatenate([scores, found[fits]])
            still = [w for w in still if not self._done(scores, w, k, int(edge))]
            depth, step = until, step * 2
        return [self._first(at, scores, w, k) for w in windows]

    @staticmethod
    def _done(scores: np.ndarray, window: tuple[int, int], k: int, edge: int) -> bool:
        if edge < window[0]:
            return True
        inside = scores[(scores >= window[0]) & (scores <= window[1])]
        return len(inside) >= k and edge < int(np.partition(inside, len(inside) - k)[len(inside) - k])

    def _first(self, at: np.ndarray, scores: np.ndarray, window: tuple[int, int], k: int) -> tuple[np.ndarray, np.ndarray]:
        inside = np.flatnonzero((scores >= window[0]) & (scores <= window[1]))
        order = inside[np.lexsort((at[inside], -scores[inside]))][:k]
        return self.ids[at[order]], scores[order]


def _matrix(column, width: int | None = None) -> np.ndarray:
    """Rows of an Arrow list column, filled with zeros up to the longest or cut to ``width``."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten())
    wide = int(sizes.max(initial=0)) if width is None else width
    rows = np.zeros((len(sizes), wide), np.int32)
    inside = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    of = np.repeat(np.arange(len(sizes)), sizes)
    rows[of[inside < wide], inside[inside < wide]] = flat[inside < wide]
    return rows


def _block(parts: list) -> SortedLists:
    """The block of some Arrow batches sorted by id; of several rows with one id the first counts."""
    import pyarrow as pa

    whole = pa.Table.from_batches(parts).combine_chunks()
    ids = np.asarray(whole.column("vec_id").combine_chunks())
    first = np.append(True, ids[1:] != ids[:-1])
    return SortedLists(ids[first], np.asarray(whole.column("label").combine_chunks())[first],
                       _matrix(whole.column("parts").combine_chunks())[first])


def _asked(batches: Iterator, answer: Callable[[SortedLists, object, int], list[tuple]]) -> Iterator[list[tuple]]:
    """Rows that ``answer`` gives for each anchor behind the rows of a task's block."""
    held, block = [], None
    for batch in batches:
        split = int((np.asarray(batch.column("kind")) == 0).sum())
        if split:
            held.append(batch.slice(0, split))
        for at in range(split, batch.num_rows):
            if block is None:
                block = _block(held) if held else None
                held = []
            if block is not None:
                yield answer(block, batch, at)


def _anchor(batch, at: int) -> np.ndarray:
    return np.array(batch.column("parts")[at].as_py(), np.int64)


def _positives_of(block: SortedLists, batch, at: int) -> list[tuple]:
    own = batch.column("vec_id")[at].as_py()
    lists = block.of_label(batch.column("label")[at].as_py())
    everything = (-(1 << 63), (1 << 63) - 1)
    [(ids, scores)] = lists.best(_padded(_anchor(batch, at), lists), [everything], POSITIVES,
                                 lambda rows: lists.ids[rows] != own)
    return [(own, int(i), int(s)) for i, s in zip(ids, scores)]


def _negatives_of(block: SortedLists, batch, at: int) -> list[tuple]:
    own, label = batch.column("vec_id")[at].as_py(), batch.column("label")[at].as_py()
    asked = batch.column("positives")[at].as_py()
    low, high = WINDOW_PERCENT
    windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in asked]
    found = block.best(_padded(_anchor(batch, at), block), windows, NEGATIVES, lambda rows: block.labels[rows] != label)
    return [(own, p["id"], p["score"], int(i), int(s))
            for p, (ids, scores) in zip(asked, found) for i, s in zip(ids, scores)]


def _padded(anchor: np.ndarray, lists: SortedLists) -> np.ndarray:
    wide = lists.rows.shape[1]
    return np.append(anchor, np.zeros(max(0, wide - len(anchor)), np.int64))[:wide]


def _in_blocks(items: DataFrame, anchors: DataFrame, blocks: int, answer, schema: str) -> DataFrame:
    """``answer`` for every anchor and block; anchors have a further column ``positives``."""
    import pyarrow as pa

    names = [c.split()[0] for c in schema.split(", ")]
    none = F.lit(None).cast(anchors.schema["positives"].dataType)
    rows = items.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"),
                        "vec_id", "label", "parts", none.alias("positives"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
                           "vec_id", "label", "parts", "positives")

    def run(batches):
        held = []
        for some in _asked(batches, answer):
            held += some
            if len(held) >= 4096:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)

    def _batch(held):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=names)

    dealt = rows.unionByName(asked).repartitionById(blocks, "block")
    return dealt.sortWithinPartitions("kind", "vec_id", "label", "parts").drop("block").mapInArrow(run, schema)


def items_of(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, parts`` of the rows that take part, with labels changed and components as whole numbers.

    A component beyond the square root of 2**62 over the vector's length counts as that, so that every score
    fits a long; at 64 dimensions that is a component of a million.
    """
    x, number = F.col(embedding), F.col(vec_id)
    limit = F.least(F.floor(F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.size(x), F.lit(1)))), F.lit((1 << 31) - 1))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    parts = F.transform(whole, lambda c: F.least(F.greatest(c, -limit), limit).cast("int"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    changed = F.when(number % RELABEL_EVERY == 0, (F.col(label) + 1) % RELABEL_MODULO).otherwise(F.col(label))
    return vectors.where(number.isNotNull() & F.col(label).isNotNull() & x.isNotNull() & usable).select(
        number.cast("long").alias("vec_id"), changed.cast("int").alias("label"), parts.alias("parts"))


def mine(vectors: DataFrame, block_rows: int = BLOCK_ROWS, vec_id: str = "vec_id", embedding: str = "embedding",
         label: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows with a null id, label or vector, or with a null or non-finite component take no part. Of several
    rows with one id the one with the smallest label and vector counts. Ties go to the smaller id. A shorter
    vector counts as filled up with zeros, one of length 0 scores 0 with all. Anchors without a positive, and
    positives without a negative in their window, give no rows; neither does an empty table. Other columns are
    not read. The number of blocks follows the number of rows, so that a block has about ``block_rows`` of them.
    """
    items = kept_in_shared_folder(items_of(vectors, vec_id, embedding, label))
    blocks = max(1, -(-items.count() // block_rows))
    anchors = items.where(F.col("vec_id") % ANCHOR_EVERY == 0).groupBy("vec_id").agg(
        F.min(F.struct("label", "parts")).alias("row")).select("vec_id", "row.label", "row.parts")
    blank = anchors.withColumn("positives", F.lit(None).cast("array<struct<id: long, score: long>>"))
    near = _in_blocks(items, blank, blocks, _positives_of, "anchor_id long, id long, score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    positives = kept_in_shared_folder(
        near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= POSITIVES)
        .groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("positives")))
    asked = anchors.join(positives, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "parts", "positives")
    found = _in_blocks(items, asked, blocks, _negatives_of,
                       "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine_sql() -> str:
    """The same rows for the SQL check, from all scores."""
    low, high = WINDOW_PERCENT
    return f"""
        WITH items AS (SELECT vec_id, CAST(CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {RELABEL_MODULO}
                ELSE label END AS INTEGER) AS label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS parts
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                CAST(list_inner_product(a.parts, b.parts) AS BIGINT) AS score
            FROM items a JOIN items b ON a.vec_id <> b.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0),
        positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id
                 ORDER BY score DESC, other_id) AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
         AND {low} * positive_score <= 100 * score AND 100 * score <= {high} * positive_score
        QUALIFY rank <= {NEGATIVES}"""
