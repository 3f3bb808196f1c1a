"""The threshold algorithm against all scores."""

import math
import random

import numpy as np
import pytest
from tests_llm_compare import connection, differences

from snapmart.llm import queries
from snapmart.llm.hard_negatives import SortedLists, mine

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    items = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        item = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        items[i] = min(items.get(i, item), item)
    out = []
    for anchor in sorted(i for i in items if i % 100 == 0):
        label, v = items[anchor]
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, own) for i, (own, w) in items.items() if i != anchor)
        for minus, positive, _ in [s for s in scored if s[2] == label][:5]:
            p, rank = -minus, 0
            for m, i, own in scored:
                if own != label and 30 * p <= -100 * m <= 90 * p and rank < 10:
                    rank += 1
                    out.append((anchor, positive, rank, i, p, -m))
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", block int")
    got = mine(df.repartition(3), **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("dims, block_rows", [(1, 100), (3, 40), (8, 1000)])
def test_random_vectors(spark, dims, block_rows):
    rng = random.Random(dims)
    rows = [(i, [rng.choice([-1.0, -0.3, 0.0, 0.25, 1.0]) + rng.choice([0.0, rng.gauss(0, 0.2)]) for _ in range(dims)],
             rng.randrange(4)) for i in range(500)]
    assert mined(spark, rows, block_rows=block_rows) == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i * 50, [rng.gauss(0.1, 0.3) for _ in range(rng.choice([4, 4, 2, 6]))], rng.randrange(3)) for i in range(60)]
    rows += [(100, [0.5] * 4, 1), (100, [0.1] * 4, 0), (7, None, 1), (8, [0.1, None, 0.2, 0.1], 1), (9, [0.1, math.nan, 1.0, 1.0], 0),
             (11, [math.inf, 0.0, 0.0, 0.0], 1), (12, [0.2] * 4, None), (None, [0.3] * 4, 1), (13, [], 1), (700, [0.0] * 4, 2)]
    rows += rows[:20]
    rows += [(1001 + i, [0.4, 0.4, 0.4, 0.4], 1 + i % 2) for i in range(40)]  # many ties
    assert mined(spark, rows, block_rows=30) == brute(rows)


def test_no_rows_one_row_and_one_label(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(i, [1.0, i / 10], 1) for i in range(1, 200) if i % 7]) == []


def test_huge_components_do_not_overflow(spark):
    rows = [(i, [1e30 * (-1) ** i, 1.0], i % 2) for i in range(1, 120)]
    assert all(abs(r[4]) < 2**63 and abs(r[5]) < 2**63 for r in mined(spark, rows))


def test_lists_are_not_read_to_their_ends():
    rng = np.random.default_rng(5)
    rows = np.sort(rng.integers(0, 10, (20_000, 2)), axis=0).astype(np.int32)
    rows[-60:] += 1000
    lists, asked = SortedLists(np.arange(20_000), np.zeros(20_000, np.int64), rows), []

    def wanted(at):
        asked.append(len(at))
        return np.ones(len(at), bool)

    [(ids, scores)] = lists.best(np.array([1, 2]), [(0, 1 << 40)], 10, wanted)
    full = rows.astype(np.int64) @ np.array([1, 2])
    order = np.lexsort((np.arange(20_000), -full))[:10]
    assert ids.tolist() == order.tolist() and scores.tolist() == full[order].tolist()
    assert sum(asked) < 1000


def test_query_over_the_whole_table(spark, sf_dir):
    got = queries.QUERIES["op11_hard_negatives"](spark, sf_dir)
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    assert differences(got, connection(sf_dir), queries.SQL["op11_hard_negatives"]) is None
