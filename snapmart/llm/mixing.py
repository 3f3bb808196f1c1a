"""Mixing sources to target weights as a curriculum that changes over training.

A source has a weight that runs over training time 0 to 1 along straight pieces. Its integral is the
source's share of the whole mix; the integral up to a time, scaled to the source's target, is the
demand up to then. The words of a source stand in a row, document by document, pass by pass; the
inverse of the demand at a document's first word is its training position. Documents are put in order
by range-sorting on it.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import free_name, hash60_sql, kept_in_shared_folder, running_totals, word_count

# Knots at equal distances over training time. The integrals are 5, 2 and 1: a large share that falls,
# one that stays, and a small one that rises.
SCHEDULES: tuple[tuple[float, ...], ...] = ((7.5, 5.0, 2.5), (2.0, 2.0, 2.0), (0.5, 1.0, 1.5))
MAX_PASSES = 3


def integral(schedule: Sequence[float]) -> float:
    step = 1.0 / (len(schedule) - 1)
    return sum((a + b) / 2 * step for a, b in zip(schedule, schedule[1:]))


def _by_rank(rank: Column, values: Sequence[float]) -> Column:
    chosen = F.lit(float(values[-1]))
    for i in range(len(values) - 2, -1, -1):
        chosen = F.when(rank % len(values) == i, F.lit(float(values[i]))).otherwise(chosen)
    return chosen


def source_targets(sized: DataFrame, schedules: Sequence[Sequence[float]] = SCHEDULES,
                   max_passes: int = MAX_PASSES) -> DataFrame:
    """``source, source_size, rank, target`` from rows of ``source, size``.

    Sources are ranked by code point, null last. A source gets ``level * weight`` of all words but
    never more than ``max_passes`` times its own; the level is the one at which all words are given
    out. The two ungrouped windows run over one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", _by_rank(F.col("rank"), [integral(s) for s in schedules]))
    # Sources by the level at which they are full; those before one in this order are full earlier.
    full = F.lit(float(max_passes)) * F.col("source_size") / F.col("weight")
    here = Window.orderBy("full_at", "rank")
    before, onwards = here.rowsBetween(Window.unboundedPreceding, -1), here.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = (
        ranked.withColumn("full_at", full)
        .withColumn("open", F.sum("source_size").over(everything)
                    - max_passes * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("at", F.col("open") / F.sum("weight").over(onwards))
        .withColumn("level", F.min(F.when(F.col("at") <= F.col("full_at"), F.struct("full_at", "rank", "at")))
                    .over(everything).getField("at"))
    )
    return levels.select(
        "source", "source_size", "rank",
        F.when(F.col("full_at") <= F.col("level"), F.lit(float(max_passes)) * F.col("source_size"))
        .otherwise(F.col("level") * F.col("weight")).alias("target"),
    )


def _time_of(share: Column, schedule: Sequence[float]) -> Column:
    """Inverse of the demand: the time by which ``share`` of the schedule's integral is used up."""
    step, whole = 1.0 / (len(schedule) - 1), integral(schedule)
    need, used, pieces = share * F.lit(whole), 0.0, []
    for i, (a, b) in enumerate(zip(schedule, schedule[1:])):
        rest, slope = need - F.lit(used), (b - a) / step
        root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2.0 * slope) * rest, F.lit(0.0)))
        pieces.append((used + (a + b) / 2 * step, F.lit(i * step) + F.lit(2.0) * rest / (F.lit(a) + root)))
        used += (a + b) / 2 * step
    time = pieces[-1][1]
    for until, value in reversed(pieces[:-1]):
        time = F.when(need < F.lit(until), value).otherwise(time)
    return F.least(time, F.lit(1.0))


def _planned(docs: DataFrame, schedules: Sequence[Sequence[float]], max_passes: int, doc_id: str, text: str,
             source: str) -> DataFrame:
    """One row per document with its place in its source's row of words and the words taken."""
    for s in schedules:
        if len(s) < 2 or any(a + b <= 0 or min(a, b) < 0 for a, b in zip(s, s[1:])):
            raise ValueError("a schedule needs two knots, none below 0 and no two neighbours of 0")
    sized = kept_in_shared_folder(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest")))
    targets = source_targets(sized, schedules, max_passes)
    rows = running_totals(sized, "source", ["doc_id", "size"], "size").join(
        targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    whole = F.floor(F.col("target")).cast("long")
    size, total = F.col("size"), F.col("source_size")
    last = whole - F.floor(whole / F.greatest(total, F.lit(1))).cast("long") * total
    in_last = F.least(F.greatest(last - F.col("amount_before"), F.lit(0)), size)
    taken = F.when(total == 0, F.lit(0)).otherwise(F.floor(whole / total).cast("long") * size + in_last)
    return rows.withColumn("taken", taken.cast("long"))


def _position(words_before: Column, schedules: Sequence[Sequence[float]]) -> Column:
    """Training time at which a source's demand reaches so many words."""
    share, position = words_before / F.col("target"), F.lit(None).cast("double")
    for i, s in enumerate(schedules):
        position = F.when(F.col("rank") % len(schedules) == i, _time_of(share, s)).otherwise(position)
    return position


def curriculum(docs: DataFrame, schedules: Sequence[Sequence[float]] = SCHEDULES, max_passes: int = MAX_PASSES,
               doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """How often each document is taken and when, one row per document, in order of first position.

    Returns ``doc_id, size, source_size, target, taken, position, source``. ``taken`` is a whole number
    of words: full passes, and in the last pass the words up to the source's target, so that a source's
    taken words are its target rounded down. ``position`` is the training time of the first word taken,
    null if none is. A null text has size 0 and is never taken; a source without words has target 0. A
    null source is a source of its own. Repeated rows count each. An empty table gives no rows. Reruns
    agree: the order in a source comes from a hash of doc_id and size.
    """
    return (
        _planned(docs, schedules, max_passes, doc_id, text, source)
        .withColumn("position", F.when(F.col("taken") > 0, _position(F.col("amount_before"), schedules)))
        .select("doc_id", "size", "source_size", "target", "taken", "position", "source")
        .sort(F.col("position").asc_nulls_last(), "doc_id", "size")  # the ids spread what has no position
    )


def training_rows(docs: DataFrame, schedules: Sequence[Sequence[float]] = SCHEDULES, max_passes: int = MAX_PASSES,
                  doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, range-sorted by training position.

    A row cannot be cut, so the pass in which a source's target falls inside a document keeps it if at
    least half of its words are taken. Documents that are never taken go, those without words among them.
    All columns stay, whatever their names. A null source is a source of its own; repeated rows count each; an
    empty table stays empty.
    """
    size, before = F.col("size"), F.col("amount_before")
    keys = ["__id", "__source", "__digest"]
    passes = F.when(size > 0, F.floor((2 * F.col("taken") + size) / (2 * size))).otherwise(F.lit(0)).cast("int")
    starts = F.transform(F.sequence(F.lit(0), F.col("passes") - 1),
                         lambda p: _position(p * F.col("source_size") + before, schedules))
    planned = kept_in_shared_folder(
        _planned(docs, schedules, max_passes, doc_id, text, source).withColumn("passes", passes)
        .select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("digest").alias("__digest"),
                F.when(F.col("passes") > 0, starts).otherwise(F.array().cast("array<double>")).alias("starts")))
    plan = planned.withColumn("__position", F.explode("starts")).drop("starts")
    # columns that stand beside those of ``docs`` have names that no column of ``docs`` has
    body, position = free_name(docs, "__body"), free_name(docs, "__position")
    names = {k: free_name(docs, k) for k in keys}
    keyed = docs.withColumn(body, F.md5(F.coalesce(F.col(text), F.lit(""))))
    own = [F.col(doc_id), F.col(source), F.col(body)]

    def matching(right: DataFrame):
        same = [a.eqNullSafe(right[names[k]]) for a, k in zip(own, keys)]
        return same[0] & same[1] & same[2]

    def beside(right: DataFrame) -> DataFrame:
        renamed = {**{k: v for k, v in names.items()}, "__position": position}
        return right.select(*[F.col(c).alias(renamed[c]) for c in right.columns])

    def same_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        other = right.select(*[F.col(k).alias(f"{k}_2") for k in keys])
        a, b, c = (left[k].eqNullSafe(other[f"{k}_2"]) for k in keys)
        return left.join(other, a & b & c, how)

    # Equal rows have a place each in the plan; they are joined as one row of ``docs``.
    repeated = kept_in_shared_folder(planned.groupBy(*keys).count().where("count > 1").select(*keys))
    if repeated.isEmpty():
        places = beside(plan)
        rows = keyed.join(places, matching(places))
    else:
        once, several = (beside(same_key(plan, repeated, how)) for how in ("left_anti", "left_semi"))
        marked = beside(repeated)
        single = keyed.join(marked, matching(marked), "left_semi").dropDuplicates([doc_id, source, body])
        rows = keyed.join(once, matching(once)).unionByName(single.join(several, matching(several)))
    return rows.sort(position, doc_id).select(*docs.columns)


def _time_of_sql(schedule: Sequence[float]) -> str:
    step, whole = 1.0 / (len(schedule) - 1), integral(schedule)
    need, used, text, last = f"(share * {whole!r})", 0.0, "", ""
    for i, (a, b) in enumerate(zip(schedule, schedule[1:])):
        rest = f"({need} - {used!r})"
        root = f"sqrt(greatest({a * a!r} + {2.0 * (b - a) / step!r} * {rest}, 0.0))"
        last = f"({i * step!r} + (2.0 * {rest}) / ({a!r} + {root}))"
        used += (a + b) / 2 * step
        text += f" WHEN {need} < {used!r} THEN {last}" if i < len(schedule) - 2 else ""
    return f"least({f'CASE{text} ELSE {last} END' if text else last}, 1.0)"


def curriculum_sql() -> str:
    """Size, target, taken words and position for the SQL check, from the same fixed values."""
    weights = " ".join(f"WHEN {i} THEN {integral(s)!r}" for i, s in enumerate(SCHEDULES))
    times = " ".join(f"WHEN {i} THEN {_time_of_sql(s)}" for i, s in enumerate(SCHEDULES))
    order = f"{hash60_sql('doc_id', 'size', '0')}, doc_id, size"
    return f"""
        WITH sized AS (SELECT doc_id, source,
                 len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
        ranked AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                 row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
        weighed AS (SELECT *, CASE rank % {len(SCHEDULES)} {weights} END AS weight,
                 {float(MAX_PASSES)!r} * source_size / weight AS full_at FROM ranked),
        levels AS (SELECT *, (sum(source_size) OVER () - {MAX_PASSES} * coalesce(sum(source_size) OVER
                   (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (ORDER BY full_at, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
                 FROM weighed),
        chosen AS (SELECT arg_min(lvl, full_at) AS level FROM levels WHERE lvl <= full_at),
        targets AS (SELECT levels.*, CASE WHEN full_at <= level THEN {float(MAX_PASSES)!r} * source_size ELSE level * weight END AS target
                 FROM levels, chosen),
        rows AS (SELECT s.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS whole,
                 sum(s.size) OVER (PARTITION BY s.source ORDER BY {order.replace('doc_id', 's.doc_id').replace('size', 's.size')}
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS before,
                 t.rank FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
        mixed AS (SELECT doc_id, size, source_size, target, rank, before / target AS share,
               CAST(CASE WHEN source_size = 0 THEN 0 ELSE (whole // source_size) * size
                 + least(greatest(whole % source_size - before, 0), size) END AS BIGINT) AS taken
               FROM rows)
        SELECT doc_id, size, source_size, target, taken,
               CASE WHEN taken > 0 THEN CASE rank % {len(SCHEDULES)} {times} END END AS position
        FROM mixed"""
