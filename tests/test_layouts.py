"""Buckets by key, digests and bitmaps: plans and results."""

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapmart.driver_tables import role
from snapmart.operators import distinct, latest
from snapmart.operators.history import deltas
from snapmart.plans.sync_job import sync_digests
from snapmart.schema import RATING, SNAPSHOT
from snapmart.sources.bucketed import read_bucketed, save_bucketed, sorted_deltas
from snapmart.sources.clustered import look_up, save_clustered
from snapmart.sources.lake import Keyed, Lake
from snapmart.streaming.deltas import Readings, deltas_into
from snapmart_checks import layouts

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def readings(spark):
    return layouts.bucketed_readings(spark, SF_DIR)


def test_nothing_is_shuffled(readings):
    order = layouts.ORDER
    for df in (latest.newest_per_group(readings, ["entity_id"], order), latest.latest_per_group(readings, "entity_id", order, 2),
               latest.latest_pair(readings, "entity_id", order, ["current_count"]),
               sorted_deltas(readings, "entity_id", order, layouts.MEASURES)):
        assert "Exchange" not in plan_of(df) and df.count() > 0


def test_one_key_is_read_from_one_bucket(readings):
    one = readings.where("entity_id = 3")
    assert "SelectedBucketsCount: 1 out of 8" in plan_of(latest.newest_per_group(one, ["entity_id"], layouts.ORDER))


def test_sorted_deltas_equal_those_in_pieces(spark, readings):
    order, names = layouts.ORDER, [f"delta_{m}" for m in layouts.MEASURES]
    want = deltas(role(spark, SF_DIR, "snapshot"), "entity_id", order, layouts.MEASURES).select("snapshot_id", *names)
    got = sorted_deltas(readings, "entity_id", order, layouts.MEASURES).select("snapshot_id", *names)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    odd = spark.createDataFrame([(1, 1, None), (1, 2, 5), (None, 1, 7), (None, 2, 9)], "k int, t int, m int")
    assert sorted(map(str, (tuple(r) for r in sorted_deltas(odd, "k", ["t"], ["m"]).collect()))) == sorted(map(str, [
        (1, 1, None, None), (1, 2, 5, None), (None, 1, 7, 0), (None, 2, 9, 2)]))


def test_a_bucket_is_one_file(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    save_bucketed(spark.range(1000).select("id", (F.col("id") % 7).alias("k")), name, "k", ["id"], 4, str(tmp_path / name))
    assert len(list((tmp_path / name).glob("*.parquet"))) <= 4 and read_bucketed(spark, name).count() == 1000


def test_distinct_counts_are_exact_and_merge(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(4), rng.choice([None, rng.randrange(-100_000, 100_000), rng.randrange(50)]))
            for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, d int, n long")
    days = distinct.bitmaps(df, "n", ["g", "d"])
    assert "Expand" not in plan_of(distinct.counted(days, ["g", "d"]))
    for by in (["g", "d"], ["g"], ["d"], []):
        got = {tuple(r)[:-1]: r[-1] for r in distinct.counted(distinct.merged(days, by), by).collect()}
        want = {}
        for g, d, n in rows:
            want.setdefault(tuple({"g": g, "d": d}[b] for b in by), set()).add(n)
        assert got == {k: len(v - {None}) for k, v in want.items() if v - {None}}
    assert distinct.counted(distinct.bitmaps(df.limit(0), "n")).first()[0] == 0


def test_digests_ignore_order_and_see_everything_else(spark, tmp_path):
    spec = {"rating": Keyed(RATING, "entity_id", 4, digested=True)}
    rows = role(spark, SF_DIR, "rating")

    def digest(df, name):
        lake = Lake(spark, str(tmp_path / name), spec)
        assert lake.digests("rating").count() == 0
        lake.rewrite("rating", df)
        stored = sorted(map(tuple, lake.digests("rating").collect()))
        lake.tables["rating"] = Keyed(RATING, "entity_id", 4)
        assert [d for d in stored if d[1]] == sorted(map(tuple, lake.digests("rating").collect()))
        return stored

    same = digest(rows, "a")
    assert same == digest(rows.orderBy(F.desc("rating_id")).repartition(5), "b")
    first = rows.agg(F.min("entity_id")).first()[0]
    blank = F.when(F.col("entity_id") == first, F.lit("")).otherwise(F.col("label"))
    for i, other in enumerate([
            rows.where(f"entity_id <> {first}"), rows.unionByName(rows.where(f"entity_id = {first}")),
            rows.withColumn("positive", F.col("positive") + (F.col("entity_id") == first).cast("int")),
            rows.withColumn("label", F.when(F.col("entity_id") != first, F.col("label"))), rows.withColumn("label", blank)]):
        assert digest(other, f"c{i}") != same


def test_only_buckets_that_differ_are_read_and_written(spark):
    source, copy = layouts.differing_lakes(spark, SF_DIR)
    stamps = {f: f for f in copy.rows("rating").inputFiles()}
    done = sync_digests(source, copy, ["rating"]).first()
    assert 0 < done["unequal_buckets"] < done["buckets"] == 32
    left = [f for f in copy.rows("rating").inputFiles() if f in stamps]
    assert len({f.split("bucket=")[1].split("/")[0] for f in left}) == 32 - done["unequal_buckets"]
    assert sorted(map(str, copy.read("rating").collect())) == sorted(map(str, source.read("rating").collect()))
    assert sync_digests(source, copy, ["rating"]).first()["unequal_buckets"] == 0
    with pytest.raises(ValueError, match="same buckets"):
        sync_digests(source, Lake(spark, copy.root, {"rating": Keyed(RATING, "entity_id", 8)}), ["rating"])


SERIES = Readings(SNAPSHOT, "snapshot_id", "entity_id", ("recorded_at", "snapshot_id"), ("current_count", "total_ratings"))


def made_readings(n, seed):
    rng = random.Random(seed)
    return [(i, rng.randrange(4), rng.randrange(100), 100, rng.randrange(50),
             datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 12))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_of_readings_in_any_order(spark, tmp_path, seed):
    rows = made_readings(120, seed)
    lake, work = Lake(spark, str(tmp_path), SERIES.tables(3)), deltas_into(SERIES)
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    for i, part in enumerate((shuffled[:50], shuffled[50:55], shuffled[53:], [])):
        work(spark.createDataFrame(part, SNAPSHOT), lake, f"b{i}")
        there = {r[0]: r for p in (shuffled[:50], shuffled[50:55], shuffled[53:])[:i + 1] for r in p}
        want = deltas(spark.createDataFrame(list(there.values()), SNAPSHOT), "entity_id", ["recorded_at", "snapshot_id"],
                      ["current_count", "total_ratings"])
        got = lake.read("reading_delta").select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_late_reading_leaves_other_days_alone(spark, tmp_path):
    at = datetime(2024, 1, 1)
    lake, work = Lake(spark, str(tmp_path), SERIES.tables(2)), deltas_into(SERIES)
    rows = [(i, i % 2, i * i, 100, i, at + timedelta(days=i // 2)) for i in range(20)]
    work(spark.createDataFrame(rows, SNAPSHOT), lake, "a")
    before = set(lake.rows("reading_delta").inputFiles())
    work(spark.createDataFrame([(99, 0, 1000, 1000, 0, at + timedelta(days=2, hours=1))], SNAPSHOT), lake, "b")
    written = set(lake.rows("reading_delta").inputFiles()) - before
    # its own day, and the key's next day
    assert len({f.split("bucket=")[1].split("/")[0] for f in written}) == 2
    found = {r["snapshot_id"]: r["delta_current_count"] for r in lake.read("reading_delta").collect()}
    assert found[99] == 1000 - 16 and found[6] == 36 - 1000 and found[8] == 64 - 36


def test_a_micro_batch_of_deltas_that_died_is_run_again(spark, tmp_path):
    class Dying(Lake):
        dies_at = ""

        def _write(self, table, rows, folders):
            if table == self.dies_at:
                raise InterruptedError(table)
            super()._write(table, rows, folders)

    rows = made_readings(60, 5)
    lake, work = Dying(spark, str(tmp_path), SERIES.tables(2)), deltas_into(SERIES)
    work(spark.createDataFrame(rows[:30], SNAPSHOT), lake, "a")
    lake.dies_at = "reading_end"
    with pytest.raises(InterruptedError):
        work(spark.createDataFrame(rows[30:], SNAPSHOT), lake, "b")
    lake.dies_at = ""
    work(spark.createDataFrame(rows[30:], SNAPSHOT), lake, "b")
    want = deltas(spark.createDataFrame(rows, SNAPSHOT), "entity_id", ["recorded_at", "snapshot_id"], ["current_count", "total_ratings"])
    assert sorted(map(tuple, lake.read("reading_delta").select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def rows_read(df):
    """Rows that the scans of a query gave, and the rows of the result."""
    got = len(df.collect())
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        if "Scan" in node.nodeName() and node.metrics().contains("numOutputRows"):
            total += node.metrics().apply("numOutputRows").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total, got


def test_look_ups_read_few_rows(spark, tmp_path):
    n, path = 200_000, str(tmp_path / "t")
    df = spark.range(0, n, 1, 4).select(
        (F.col("id") * 7919 % 1000).alias("k"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("t"),
        F.md5(F.col("id").cast("string")).alias("name"))
    save_clustered(df, path, ["k", "t"], 8, {"name": 20_000}, row_group_bytes=256 * 1024)
    stored = spark.read.parquet(path)
    assert rows_read(stored) == (n, n)
    read, got = rows_read(look_up(stored, "k", 77))
    assert got == 200 and read <= n / 8
    read, got = rows_read(look_up(stored, "k", 77, "t", "1970-01-01 05:00:00", "1970-01-01 06:00:00"))
    assert 0 < got < 200 and read <= n / 8
    # the name stands anywhere: only Bloom filters can leave row groups out
    wanted = df.where("k = 500").first()["name"]
    read, got = rows_read(look_up(stored, "name", wanted))
    assert got == 1 and read <= n / 4
    read, got = rows_read(look_up(stored, "name", "no such name"))
    assert got == 0 and read <= n / 10


def test_affected_days_are_found_without_pairs_of_days(spark, tmp_path):
    """Each reading touches one day, so no join may meet every later day of its key."""
    plans = {}

    class Watched(Lake):
        def keep(self, name, rows):
            plans[name] = rows._jdf.queryExecution().optimizedPlan().toString()
            return super().keep(name, rows)

    at = datetime(2024, 1, 1)
    lake, work = Watched(spark, str(tmp_path), SERIES.tables(2)), deltas_into(SERIES)
    rows = [(i, i % 2, i * i, 100, i, at + timedelta(days=i // 2)) for i in range(12)]
    work(spark.createDataFrame(rows[:4] + rows[8:], SNAPSHOT), lake, "a")
    work(spark.createDataFrame(rows[4:8], SNAPSHOT), lake, "b")
    assert "Join" not in plans["deltas_affected"]
    want = deltas(spark.createDataFrame(rows, SNAPSHOT), "entity_id", ["recorded_at", "snapshot_id"], ["current_count", "total_ratings"])
    assert sorted(map(tuple, lake.read("reading_delta").select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
