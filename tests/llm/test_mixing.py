"""Targets, taken words and positions."""

import math
from collections import defaultdict

import pytest

from snapmart.llm import mixing, queries
from snapmart.llm.mixing import SCHEDULES, curriculum, integral, training_rows
from tests_llm_compare import connection, differences


def targets(sizes):
    """By rounds: shares by weight, what is above three times a source's size is shared out again."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [None] * (None in sizes)
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    full, rest = {}, float(sum(sizes.values()))
    while True:
        open_now = [n for n in names if n not in full]
        total = sum(weight[n] for n in open_now)
        share = {n: rest * weight[n] / total for n in open_now}
        over = [n for n in open_now if share[n] > 3 * sizes[n]]
        if not over:
            return full | share
        for n in over:
            full[n] = 3.0 * sizes[n]
            rest -= full[n]


def test_query_equals_sql(spark, sf_dir):
    assert differences(queries.QUERIES["op4_mixing"](spark, sf_dir), connection(sf_dir), queries.SQL["op4_mixing"]) is None


def test_integrals_are_the_weights():
    assert [integral(s) for s in SCHEDULES] == [5.0, 2.0, 1.0]


def check(rows):
    by_source, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        by_source[r.source].append(r)
        sizes[r.source] += r.size
    want = targets(sizes)
    for s, own in by_source.items():
        assert all(r.source_size == sizes[s] for r in own)
        assert math.isclose(own[0].target, want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert sum(r.taken for r in own) == math.floor(own[0].target) if sizes[s] else all(r.taken == 0 for r in own)
        assert all(0 <= r.taken <= 3 * r.size for r in own)
        assert all((r.position is None) == (r.taken == 0) for r in own)
    positions = [r.position for r in rows if r.position is not None]
    assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)


def test_small_large_and_odd_sources(spark):
    rows = [(i, "w " * (i % 7 + 1), "b") for i in range(500)] + [(1000 + i, "one two", "a") for i in range(3)]
    rows += [(2000 + i, "x y z", None) for i in range(40)] + [(3000, None, "c"), (None, "null id", "d"), (3001, "", "ä")]
    rows += [(9, "same row", "b")] * 9000
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("rank", mixing.F.lit("x"))
    got = curriculum(df).collect()
    assert len(got) == len(rows)
    check(got)
    again = curriculum(df.repartition(5)).collect()
    key = [(str(r.doc_id), str(r.source), r.size, r.taken, str(r.position)) for r in got]
    assert sorted(key) == sorted((str(r.doc_id), str(r.source), r.size, r.taken, str(r.position)) for r in again)
    assert curriculum(df.limit(0)).count() == 0


def test_positions_invert_the_demand(spark):
    df = spark.createDataFrame([(i, "a b c d", f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    rows = curriculum(df).collect()
    for s, schedule in zip(("s0", "s1", "s2"), SCHEDULES):
        own = sorted(r.position for r in rows if r.source == s and r.position is not None)
        step = 4 / next(r.target for r in rows if r.source == s)
        for i, p in enumerate(own):
            whole, used, at = integral(schedule), 0.0, 0.0
            for k, (a, b) in enumerate(zip(schedule, schedule[1:])):
                x = min(max(p - k / 2, 0.0), 0.5)
                used += a * x + (b - a) * x * x
            assert math.isclose(used / whole, i * step, abs_tol=1e-9)


def test_training_rows(spark):
    rows = [(i, f"text number {i} of b", "b", i) for i in range(60)] + [(100, "tiny source", "a", 1)] + [(7, "dup dup", "b", 1)] * 4
    rows += [(None, "no id", None, 0), (200, None, "b", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    got = training_rows(df)
    assert got.columns == df.columns
    plan = curriculum(df).collect()
    want = defaultdict(int)
    for r in plan:
        want[(r.doc_id, r.source, r.size)] += (2 * r.taken + r.size) // (2 * r.size) if r.size else 0
    found = defaultdict(int)
    for r in got.collect():
        found[(r.doc_id, r.source, len((r.text or "").split()))] += 1
    assert dict(found) == {k: n for k, n in want.items() if n}
    assert training_rows(df.limit(0)).count() == 0


def test_schedules_that_cannot_be_inverted_are_refused(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    for bad in (((1.0,),), ((0.0, 0.0, 1.0),), ((-1.0, 2.0),)):
        with pytest.raises(ValueError):
            curriculum(df, bad)
