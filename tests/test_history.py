import re

import pytest
from pyspark.sql import functions as F

from snapmart.operators.history import deltas
from snapmart.operators.latest import latest_pair, latest_per_group
from snapmart.operators.skew import dense_ids

ORDER, MEASURES = ["at", "id"], ["count"]


def series(spark, rows):
    return spark.createDataFrame(rows, "id long, key long, at long, count long")


def brute_force(rows):
    last, out = {}, {}
    for id_, key, at, count in sorted(rows, key=lambda r: (r[2], r[0])):
        before = last.get(key, (count,))[0]
        out[id_] = None if count is None or before is None else count - before
        last[key] = (count,)
    return out


@pytest.fixture(scope="module")
def skewed():
    # key 0 holds a third of all rows and many of them share a time; two keys are absent (null)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else (None if i % 1000 == 1 else i % 17)
        rows.append((i, key, (i * 7919) % 600 if key else (i * 31) % 40, None if i % 97 == 0 else (i * i) % 1009))
    return rows


@pytest.mark.parametrize("piece", [None, "floor(at / 50)", "at", "0"])
def test_pieces_fit_together(spark, skewed, piece):
    result = deltas(series(spark, skewed), "key", ORDER, MEASURES, piece=piece and F.expr(piece))
    got = {r["id"]: r["delta_count"] for r in result.collect()}
    assert got == brute_force(skewed)


def test_a_key_with_most_rows_is_dealt_by_hour(spark):
    rows = spark.range(40_000).select(
        F.col("id"), F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("key"),
        F.timestamp_seconds(F.col("id") * 30).alias("at"), (F.col("id") * 7 % 1001).alias("count"))
    result = deltas(rows, "key", ["at", "id"], ["count"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    # the rows are dealt by key and hour; only one row per piece is dealt by the key alone
    assert "hashpartitioning(key" in plan and "__piece" in plan
    assert not re.search(r"Window[^\n]*\[key#\d+L\], \[at#", plan)
    total = result.where("key = 0").agg(F.sum("delta_count")).first()[0]
    own = rows.where("key = 0").agg(F.max_by("count", "id") - F.min_by("count", "id")).first()[0]
    assert total == own and result.count() == 40_000


def test_first_row_is_zero_and_ties_use_id(spark):
    rows = [(1, 1, 5, 10), (2, 1, 5, 30), (3, 2, 1, 8)]
    got = {r["id"]: r["delta_count"] for r in deltas(series(spark, rows), "key", ORDER, MEASURES).collect()}
    assert got == {1: 0, 2: 20, 3: 0}


def test_empty(spark):
    assert deltas(series(spark, []), "key", ORDER, MEASURES).collect() == []


def test_latest(spark):
    rows = [(1, 1, 5, 10), (2, 1, 5, 30), (3, 1, 4, 7), (4, 2, 1, 8)]
    got = {(r["key"], r["recency"], r["id"]) for r in latest_per_group(series(spark, rows), "key", ORDER, 2).collect()}
    assert got == {(1, 1, 2), (1, 2, 1), (2, 1, 4)}
    pairs = latest_pair(series(spark, rows), "key", ORDER, ["count"]).collect()
    assert [(p["key"], p["count"], p["previous_count"]) for p in pairs] == [(1, 30, 10)]


def test_partial_limit_below_the_shuffle(spark):
    plan = latest_per_group(series(spark, [(1, 1, 1, 1)]), "key", ORDER, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dense_ids(spark):
    frame = spark.range(500).select(F.format_string("%05d", (F.col("id") * 37) % 500).alias("name"))
    rows = dense_ids(frame, ["name"], "n", start=10).orderBy("name").collect()
    assert [r["n"] for r in rows] == list(range(11, 511))
    assert dense_ids(frame.limit(0), ["name"], "n").collect() == []
