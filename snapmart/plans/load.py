"""One load step: raw feeds into the stored tables, as one batch."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import scalars
from snapmart.operators import changes, quality
from snapmart.operators.audit import audit_headers, audit_rows
from snapmart.operators.skew import dense_ids
from snapmart.sources import feeds
from snapmart.sources.lake import ADDED_IN, BATCH, Lake
from snapmart.sources.tables import with_valid_peak

POLL = "polled_at"
ENTITY_FIELDS = ["name", "description", "price", "released", "maker", "publisher"]
RATING_FIELDS = ["positive", "negative", "positive_pct", "label"]
SNAPSHOT_FIELDS = ["current_count", "peak_count", "total_ratings"]
TEXT_LENGTH = 255
# What a load numbers on from the highest number there is.
ID_COLUMNS = {"entity": "entity_id", "category": "category_id", "snapshot": "snapshot_id", "rating": "rating_id",
              "audit": "audit_id"}


@dataclass(frozen=True)
class Feeds:
    """Raw answers of one or more polls; each frame has ``polled_at`` and ``body``."""

    ranking: DataFrame
    details: DataFrame
    ratings: DataFrame
    current: DataFrame

    @staticmethod
    def landed(raw: DataFrame) -> Feeds:
        """Split landing rows (``schema.LANDED``) by feed."""
        def one(name: str) -> DataFrame:
            return raw.where(F.col("feed") == name).select(POLL, "external_id", "body")

        return Feeds(one("ranking"), one("details"), one("ratings"), one("current"))


def load_rules() -> list[quality.Rule]:
    """What the stored tables would refuse."""
    return [
        quality.max_length("maker", TEXT_LENGTH),
        quality.max_length("publisher", TEXT_LENGTH),
        quality.Rule("category_name_not_blank", F.forall("categories", lambda c: c.isNull() | scalars.not_blank(c))),
        quality.Rule("price_readable", F.col("price").isNotNull()),
        quality.Rule("ratings_readable", F.col("total_ratings").isNotNull()),
        quality.Rule("price_not_negative", F.col("price") >= 0),
        *[quality.Rule(f"{c}_not_negative", F.col(c) >= 0)
          for c in (*SNAPSHOT_FIELDS, "positive", "negative")],
    ]


def load_batch(lake: Lake, raw: Feeds, number: int, as_of=None, **options) -> DataFrame:
    """``load`` as the batch of that number; run again it gives the same tables."""
    tally = load(lake, raw, f"load-{number:012d}", as_of, **options)
    return tally.select(F.lit(number).cast("long").alias("batch"), "*")


def load(lake: Lake, raw: Feeds, batch: str, as_of=None, top_n: int = 100, user: str = "loader",
         database: str = "snapmart", collation: str | None = None, audited: bool = True) -> DataFrame:
    """Load polls as one batch and return one row of tallies; the same batch run again gives the same tables.

    Entities are found by their external id. Rows that break a rule, and documents
    that cannot be read, are kept apart with the reasons and do not stop the
    others. ``as_of`` is one moment for the whole batch. Parents are written before what refers to them.
    """
    moment = datetime.now(timezone.utc).replace(tzinfo=None) if as_of is None else as_of
    ranking = feeds.read_ranking(raw.ranking, top_n)
    # read for the rows and for what is unreadable
    documents = lake.keep("load_documents", feeds.all_details(_one_answer(raw.details)))
    details = documents.where("success").drop("success", "reasons", "fetched_id")
    answers = details, feeds.read_ratings(_one_answer(raw.ratings)), feeds.read_current(_one_answer(raw.current))
    checked = lake.keep("load_checked", quality.with_reasons(feeds.assemble(ranking, *answers, POLL), load_rules()))
    valid, rejected = checked.where("reasons IS NULL").drop("reasons"), checked.where("reasons IS NOT NULL")
    newest = lake.keep("load_newest", changes.last_by_key(valid, ["external_id"], [POLL, "position"]))

    start = lake.highest(ID_COLUMNS, batch)
    entities = _merged(lake, "entity", batch, newest.select("external_id", *ENTITY_FIELDS), ["external_id"], ENTITY_FIELDS,
                       "entity_id", start, moment, "created_at", "updated_at")
    # the ids are used after the table has changed
    entities = replace(entities, rows=lake.keep("load_entities", entities.rows))
    ids = entities.rows.where(F.col(changes.ACTION) != changes.KEEP).select("external_id", "entity_id", changes.ACTION)
    known = ids.select("external_id", "entity_id")
    readings = _readings(valid.join(known, "external_id"), start["snapshot"])
    if audited:
        _log(lake, batch, entities, readings, start["audit"], moment, user, database, collation)
    entities.write()

    named = newest.select("external_id", F.explode("categories").alias("category_name"))
    present = lake.earlier("category", batch)
    added = changes.new_dimension_rows(present.drop(BATCH), named, "category_id", "category_name", collation=collation,
                                       start_id=start["category"])
    lake.add("category", added, batch)
    pairs = _category_pairs(named.join(known, "external_id"), present.drop(BATCH).unionByName(added), collation)
    touched = lake.touched("bridge", known)
    lake.rewrite("bridge", changes.replace_children(lake.rows("bridge", touched).drop(ADDED_IN), pairs, "entity_id", known), touched)

    lake.add("snapshot", readings, batch)

    # an item without an answer in its last poll keeps what it had
    answered = changes.last_by_key(valid.where("rated"), ["external_id"], [POLL, "position"])
    votes = lake.keep("load_votes", answered.join(known, "external_id").select("entity_id", *RATING_FIELDS))
    _merged(lake, "rating", batch, votes, ["entity_id"], RATING_FIELDS, "rating_id", start).write()

    bad = documents.where("reasons IS NOT NULL").select(F.col("fetched_id").alias("external_id"), POLL, "reasons")
    lake.add("quarantine", rejected.select("external_id", POLL, "reasons").unionByName(bad), batch)
    return _tally(ranking, checked, ids, added)


@dataclass(frozen=True)
class Merged:
    """Touched buckets of a table before and after a batch; ``rows`` have the column ACTION."""

    lake: Lake
    table: str
    buckets: list[int]
    before: DataFrame
    rows: DataFrame

    def write(self) -> None:
        self.lake.rewrite(self.table, self.rows.drop(changes.ACTION), self.buckets)


def _merged(lake: Lake, table: str, batch: str, source: DataFrame, keys: list[str], fields: list[str], id_col: str,
            start: Mapping[str, int], *stamps) -> Merged:
    buckets = lake.touched(table, source)
    before = lake.earlier(table, batch, buckets)
    rows = changes.merge(before, source, keys, fields, id_col, *stamps, start_id=start[table])
    inserted = F.col(changes.ACTION) == changes.INSERT
    return Merged(lake, table, buckets, before,
                  rows.withColumn(ADDED_IN, F.when(inserted, F.lit(batch)).otherwise(F.col(ADDED_IN))))


def _readings(valid: DataFrame, start: int) -> DataFrame:
    """The numbered readings of every poll."""
    rows = with_valid_peak(valid).select("entity_id", "position", *SNAPSHOT_FIELDS, F.col(POLL).alias("recorded_at"))
    return dense_ids(rows, ["recorded_at", "position", "entity_id"], "snapshot_id", start).drop("position")


def _one_answer(raw: DataFrame) -> DataFrame:
    """One answer per item and poll. Which of the answers to a repeated fetch came last is not known, so
    the longest is taken, which was not cut short, and of those the greatest, so that it is always the same."""
    best = F.max(F.struct(F.length("body").alias("n"), "body"))
    return raw.groupBy(POLL, "external_id").agg(best.getField("body").alias("body"))


def _category_pairs(named: DataFrame, categories: DataFrame, collation: str | None) -> DataFrame:
    def folded(c: str):
        return F.col(c) if collation is None else F.collate(F.col(c), collation)

    wanted = named.select("entity_id", F.substring("category_name", 1, 100).alias("__wanted"))
    return wanted.join(categories, folded("__wanted") == folded("category_name")).select("entity_id", "category_id")


def _log(lake: Lake, batch: str, entities: Merged, readings: DataFrame, start: int, moment, user: str, database: str,
         collation: str | None) -> None:
    """Log the inserted and the updated entities and the new readings, each row with its own changed fields.

    The log is written before the tables, while the old rows are there. A batch that runs again after it died
    among the tables finds its log and leaves it as it is.
    """
    if not lake.rows("audit").where((F.col(BATCH) == batch) & (F.col("table_name") == "snapshot")).isEmpty():
        return
    action = F.col(changes.ACTION)
    inserted, updated = (entities.rows.where(action == a) for a in (changes.INSERT, changes.UPDATE))
    before = entities.before.join(updated.select("entity_id"), "entity_id", "left_semi")

    def images(number: int, first: DataFrame, second: DataFrame, key: str, tracked, table: str) -> DataFrame:
        columns = lake.tables[table].schema.fieldNames()
        return audit_rows(first.select(*columns), second.select(*columns), key, tracked, table, database, moment, user,
                          collation=collation, audit_id=start + number)

    lake.add("audit_row", reduce(DataFrame.unionByName, [
        images(1, inserted.limit(0), inserted, "entity_id", ENTITY_FIELDS, "entity"),
        images(2, before, updated, "entity_id", ENTITY_FIELDS, "entity"),
        images(3, readings.limit(0), readings, "snapshot_id", SNAPSHOT_FIELDS, "snapshot"),
    ]), batch)
    written = lake.rows("audit_row").where(F.col(BATCH) == batch)
    lake.add("audit", audit_headers(written, [*ENTITY_FIELDS, *SNAPSHOT_FIELDS]), batch)


def _tally(ranking: DataFrame, checked: DataFrame, ids: DataFrame, categories: DataFrame) -> DataFrame:
    """One row of counts; every valid row is a reading."""
    one = F.count(F.lit(1))
    # each frame is read once
    counts = [
        (ranking, {"ranked": one}), (checked, {"assembled": one, "rejected": F.count("reasons")}), (categories, {"named": one}),
        (ids, {a: F.count_if(F.col(changes.ACTION) == a) for a in (changes.UPDATE, changes.INSERT)}),
    ]
    rows = [df.agg(F.map_from_arrays(F.array(*map(F.lit, wanted)), F.array(*wanted.values())).alias("rows")) for df, wanted in counts]
    found = reduce(DataFrame.unionByName, rows).select(F.explode("rows").alias("name", "rows"))
    row, spark = {r["name"]: r["rows"] for r in found.collect()}, ids.sparkSession
    loaded = row["assembled"] - row["rejected"]
    return spark.createDataFrame(
        [(loaded, row["ranked"] - row["assembled"], row["rejected"], row[changes.UPDATE], row[changes.INSERT], loaded,
          row["named"])],
        "loaded long, skipped long, rejected long, entities_updated long, entities_inserted long, "
        "snapshots_inserted long, categories_inserted long")
