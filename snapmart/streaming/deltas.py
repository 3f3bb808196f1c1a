"""Differences between readings, kept up to date while readings arrive in any order.

Readings lie in one folder per day, each with its differences. Beside them stand the ends: for every key and day the
last measures of that day. A reading changes its own difference and that of the next reading of its key, which is in
the same day or is the first of the key's next day. So a micro-batch reads the ends of its keys and the days that it
touches, works out the days of those keys anew, and writes these days and ends; all other days stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.operators import history
from snapmart.operators.changes import last_by_key
from snapmart.sources.lake import Keyed, Lake

READINGS, ENDS, DAY = "reading_delta", "reading_end", "day"


@dataclass(frozen=True)
class Readings:
    """The columns of a series of readings. ``order_by`` begins with the time and ends in the unique ``id``."""

    schema: T.StructType
    id: str
    key: str
    order_by: tuple[str, ...]
    measures: tuple[str, ...]
    prefix: str = "delta_"

    def day(self) -> Column:
        return F.unix_date(F.col(self.order_by[0]).cast("date"))

    def tables(self, buckets: int = 64) -> dict[str, Keyed]:
        """The two tables that a lake needs."""
        kinds = {f.name: f.dataType for f in self.schema.fields}
        measured = [T.StructField(m, kinds[m]) for m in self.measures]
        rows = T.StructType([*self.schema.fields, *[T.StructField(self.prefix + m, kinds[m]) for m in self.measures]])
        ends = T.StructType([T.StructField(self.key, kinds[self.key]), T.StructField(DAY, T.IntegerType()),
                             T.StructField("last", T.StructType(measured))])
        return {READINGS: Keyed(rows, self.id, place=self.day), ENDS: Keyed(ends, self.key, buckets)}


def deltas_into(spec: Readings):
    """Work for ``jobs.into``: takes new readings into the tables of ``spec``.

    A reading that is there already, by its id and day, is replaced. Readings without a key, id or time are left
    out. Run again, a micro-batch gives the same tables.
    """
    pair = [spec.key, DAY]

    def work(rows: DataFrame, lake: Lake, batch: str) -> None:
        named = rows.where(F.col(spec.key).isNotNull() & F.col(spec.id).isNotNull() & F.col(spec.order_by[0]).isNotNull())
        new = lake.keep("deltas_new", last_by_key(named.select(*spec.schema.fieldNames()), [spec.id], spec.order_by)
                        .withColumn(DAY, spec.day()))
        buckets = lake.touched(ENDS, new)
        if not buckets:
            return
        known = lake.read_buckets(ENDS, buckets)
        # every day of a key once, touched or not; the day behind a touched one is affected as well
        both = known.select(*pair, F.lit(False).alias("__touched")).unionByName(new.select(*pair, F.lit(True).alias("__touched")))
        marked = both.groupBy(*pair).agg(F.max("__touched").alias("__touched"))
        behind = F.lag("__touched", 1, False).over(Window.partitionBy(spec.key).orderBy(DAY)).alias("__behind")
        affected = lake.keep("deltas_affected", marked.select("*", behind).where("__touched OR __behind").select(*pair))
        days = sorted(r[0] for r in affected.select(DAY).distinct().collect())
        stored = lake.read_buckets(READINGS, days).withColumn(DAY, spec.day())
        inside = stored.join(affected, pair, "left_semi").select(*spec.schema.fieldNames(), DAY)
        # used for the ends and for the differences
        pieces = lake.keep("deltas_pieces", inside.join(new.select(spec.id), spec.id, "left_anti").unionByName(new))
        ends = lake.keep("deltas_ends", known.join(affected, pair, "left_anti").unionByName(
            history.ends_of(pieces, spec.key, DAY, spec.order_by, spec.measures)))
        worked = history.with_deltas(pieces, history.carried(ends, spec.key, DAY), spec.key, DAY, spec.order_by, spec.measures,
                                     spec.prefix)
        others = stored.join(affected, pair, "left_anti")
        lake.rewrite(READINGS, others.unionByName(worked.select(*others.columns)), days)
        # behind the readings: a batch that dies between the two works the same days out again
        lake.rewrite(ENDS, ends, buckets)

    return work
