"""How filters interact: what each removes in every order, from survivors of every subset.

A document that fails the filters of mask ``m`` survives a set S of filters if ``m & S`` is 0. With five
filters there are 32 sets, so a document becomes one word of 32 bits, bit S set if it survives S. Counting
each bit over the documents of a part gives the survivors of every set, and those give all figures: what a
filter removes behind a set S is survivors(S) - survivors(S with the filter). Words are added by carry-save:
three words of one weight become one of that weight and one of twice the weight, until at most two of each
are left, and only those are taken apart into bits.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import kept_in_shared_folder, map_texts

# Fixed values of the contract: the filters in order of their bits, and what they ask.
FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
SYMBOLS = b"#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SETS = 1 << len(FILTERS)
ALL = SETS - 1
DUPLICATE = 1 << FILTERS.index("E")
# Copies of one text are dealt over so many places.
SALTS = 32
# Labels of a document as a number: 1 good, 2 toxic.
CLASSES = 4


def own_failures(text: str | None) -> tuple[int, bytes]:
    """Mask of the filters A to D that a text fails, and a digest of the text; null counts as empty."""
    body = (text or "").encode()
    words = body.split()
    upper = len(body) - len(body.translate(None, UPPER))
    failed = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * upper > MAX_UPPER_PERCENT * len(text or ""),
        len(body.translate(None, SYMBOLS)) < len(body),
    )
    return sum(1 << i for i, f in enumerate(failed) if f), hashlib.md5(body).digest()


def survival_words(masks: np.ndarray) -> np.ndarray:
    """For each failure mask the word whose bit S says that nothing of S fails."""
    sets = np.arange(SETS, dtype=np.uint32)
    survives = (np.arange(SETS, dtype=np.uint32)[:, None] & sets) == 0
    table = (survives.astype(np.uint64) << sets.astype(np.uint64)).sum(axis=1).astype(np.uint32)
    return table[masks]


def bit_counts(words: np.ndarray) -> np.ndarray:
    """How many of ``words`` have each of the 32 bits."""
    counts, weight = np.zeros(SETS, np.int64), 1
    level = words.astype(np.uint32)
    while len(level):
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c = level[:third], level[third:2 * third], level[2 * third:3 * third]
            both = a ^ b
            carries.append((a & b) | (both & c))
            level = np.concatenate([both ^ c, level[3 * third:]])
        bits = (level[:, None] >> np.arange(SETS, dtype=np.uint32)) & np.uint32(1)
        counts += weight * bits.sum(axis=0, dtype=np.int64)
        level = np.concatenate(carries) if carries else level[:0]
        weight *= 2
    return counts


def _marked(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, source: str, label_id: str, quality: str,
            toxic: str) -> DataFrame:
    """``part, class, mask`` of every row of ``docs``.

    Only ids, parts and digests are shuffled. First ids are counted in the map tasks; only those of texts that
    are there more than once are joined, each in SALTS places, so that no task gets all copies of a text.
    """
    row = F.struct(F.col(doc_id).alias("id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part")).alias("row")
    judged = map_texts(docs.select(row, F.col(text).alias("text")), "row", "text",
                       lambda texts: [list(c) for c in zip(*map(own_failures, texts))], "mask int, digest binary")
    rows = kept_in_shared_folder(judged.select("row.id", "row.part", "mask", "digest"))
    # a text that very many rows share meets its first id in so many places
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 AND first IS NOT NULL").select(
        F.col("digest").alias("__digest"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    marks = labels.groupBy(F.col(label_id).alias("__id")).agg(
        F.max(F.when(F.col(quality) == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col(toxic) == 1, 2).otherwise(0)).alias("bad")).where("__id IS NOT NULL AND good + bad > 0")
    # a missing id counts as larger than any other
    copied = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first")))
    return (
        rows.withColumn("salt", salt)
        .join(first, (F.col("digest") == F.col("__digest")) & (F.col("salt") == F.col("__salt")), "left")
        .join(marks, F.col("id") == F.col("__id"), "left")
        .select("part", F.coalesce(F.col("good") + F.col("bad"), F.lit(0)).alias("class"),
                F.when(copied, F.col("mask").bitwiseOR(F.lit(DUPLICATE))).otherwise(F.col("mask")).alias("mask"))
    )


def survivors(marked: DataFrame) -> DataFrame:
    """``part, class, survivors`` from ``part, class, mask``: an array of 32 counts, by the number of the set.

    A task adds the words of each batch of rows and sends one row per part and class in it; the sums of the
    arrays are combined in the map tasks again.
    """
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(0).dictionary_encode()
            classes = np.asarray(batch.column(1)).astype(np.int64)
            words = survival_words(np.asarray(batch.column(2)).astype(np.int64))
            key = np.asarray(parts.indices).astype(np.int64) * CLASSES + classes
            order = np.argsort(key, kind="stable")
            keys, starts = np.unique(key[order], return_index=True)
            counts = [bit_counts(w) for w in np.split(words[order], starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [parts.dictionary.take(pa.array(keys // CLASSES)), pa.array(keys % CLASSES, pa.int32()),
                 *[pa.array([int(c[s]) for c in counts], pa.int64()) for s in range(SETS)]],
                names=["part", "class", *[f"s{s}" for s in range(SETS)]])

    counted = marked.select("part", "class", "mask").mapInArrow(
        run, "part string, class int, " + ", ".join(f"s{s} long" for s in range(SETS)))
    sums = ", ".join(f"sum(s{s})" for s in range(SETS))
    return counted.groupBy("part", "class").agg(F.expr(f"array({sums})").alias("survivors"))


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """``order, step, number of the set before, bit of the filter`` for every order and step."""
    rows = []
    for order in permutations(filters):
        before = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(order), step, before, 1 << filters.index(f)))
            before |= rows[-1][3]
    return rows


def _lost(counts: Column, before: Column, bit: Column) -> Column:
    """What a filter removes behind a set that does not hold it."""
    return F.element_at(counts, before + 1) - F.element_at(counts, before.bitwiseOR(bit) + 1)


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          label_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """One row per part, order of the five filters, and step, with the counts of documents.

    ``kept`` and ``removed`` at this step; ``redundant`` fail its filter but were removed earlier;
    ``unique_fails`` fail its filter only; ``good_lost`` and ``toxic_lost`` are the removed with such a label;
    ``shapley`` is what its filter removes, summed over all orders. A part is a source; null and empty ones
    are the part ''. Null texts count as empty, and as equal to empty ones. Every row counts, repeated ones
    too; rows equal in id and text are no smaller id's copies. A null id is larger than any other and has no
    label. Of several labels of an id one that says 1 suffices. Other columns are not read. An empty table gives no rows.
    """
    totals = survivors(_marked(docs, labels, doc_id, text, source, label_id, quality, toxic))

    # one text each: thousands of small expressions would take the driver seconds to put together
    def summed(wanted: str) -> Column:
        return F.expr("array(" + ", ".join(f"coalesce(sum(CASE WHEN {wanted} THEN survivors[{s}] END), 0)" for s in range(SETS)) + ")")

    parts = totals.groupBy("part").agg(
        summed("true").alias("every"), summed("class & 1 > 0").alias("good"), summed("class & 2 > 0").alias("toxic"))
    steps = ", ".join(f"named_struct('filter_order', '{o}', 'step', {s}, 'before', {b}, 'bit', {f})" for o, s, b, f in orders())
    rows = parts.select("part", "every", "good", "toxic", F.expr(_shapley_sql()).alias("shapley"), F.expr(f"inline(array({steps}))"))
    before, bit = F.col("before"), F.col("bit")
    removed = _lost(F.col("every"), before, bit)
    failing = _lost(F.col("every"), F.lit(0), bit)
    alone = _lost(F.col("every"), F.lit(ALL).bitwiseXOR(bit), bit)
    return rows.select(
        "part", "filter_order", "step", F.element_at("every", before.bitwiseOR(bit) + 1).alias("kept"),
        removed.alias("removed"), (failing - removed).alias("redundant"), alone.alias("unique_fails"),
        _lost(F.col("good"), before, bit).alias("good_lost"), _lost(F.col("toxic"), before, bit).alias("toxic_lost"),
        F.element_at("shapley", bit).alias("shapley"))


def _shapley_sql() -> str:
    """A map from the bit of each filter to what it removes over all orders, from the array ``every``.

    Behind a set of k other filters it stands in k! (n - 1 - k)! orders.
    """
    n, entries = len(FILTERS), []
    for i in range(n):
        bit = 1 << i
        terms = (f"{factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())}L * (every[{s}] - every[{s | bit}])"
                 for s in range(SETS) if not s & bit)
        entries.append(f"{bit}, {' + '.join(terms)}")
    return f"map({', '.join(entries)})"


def audit_sql() -> str:
    """The same counts for the SQL check, from failure masks and not from survivors."""
    words = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
    places = ", ".join(f"strpos(filter_order, '{f}') AS p{f}" for f in FILTERS)
    earlier = " + ".join(f"CASE WHEN p{f} < step THEN {1 << i} ELSE 0 END" for i, f in enumerate(FILTERS))
    joins = " ".join(f"JOIN letters l{i} ON l{i}.f NOT IN ({', '.join(f'l{j}.f' for j in range(i))})"
                     for i in range(1, len(FILTERS)))
    return f"""
        WITH bodies AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        firsts AS (SELECT t, min(doc_id) AS first FROM bodies GROUP BY t),
        marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                  max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
        masks AS (SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
               CASE WHEN len({words}) < {MIN_WORDS} THEN 1 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct({words})) < {MIN_DISTINCT_PERCENT} * len({words}) THEN 2 ELSE 0 END
             + CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_UPPER_PERCENT} * len(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN b.doc_id > first THEN 16 ELSE 0 END AS m
             FROM bodies b JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
        grouped AS (SELECT part, good, bad, m, count(*) AS n FROM masks GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
        orders AS (SELECT concat({', '.join(f'l{i}.f' for i in range(len(FILTERS)))}) AS filter_order FROM letters l0 {joins}),
        steps AS (SELECT *, {places}, CAST(pow(2, strpos('{FILTERS}', substr(filter_order, step, 1)) - 1) AS BIGINT) AS bit
                  FROM orders, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step)),
        sets AS (SELECT *, {earlier} AS before FROM steps),
        counted AS (SELECT part, filter_order, step, bit,
               sum(CASE WHEN m & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN m & before = 0 AND m & bit > 0 THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN m & before > 0 AND m & bit > 0 THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN m = bit THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN m & before = 0 AND m & bit > 0 THEN n * good ELSE 0 END) AS good_lost,
               sum(CASE WHEN m & before = 0 AND m & bit > 0 THEN n * bad ELSE 0 END) AS toxic_lost
               FROM grouped, sets GROUP BY ALL)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM counted"""
