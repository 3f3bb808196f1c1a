"""Links and components of vectors against all pairs in double precision."""

import numpy as np
import pytest

from snapmart.llm import embeddings, queries
from snapmart.llm.embeddings import near_duplicates, plan_tables


def brute(vectors, threshold=0.9):
    names = list(vectors)
    links = dict.fromkeys(names, 0)
    parent = {n: n for n in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        for b in names[:i]:
            x, y = vectors[a], vectors[b]
            if len(x) != len(y):
                continue
            if float(x @ y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {n: (links[n], find(n)) for n in names}


def made(rng, n, size):
    found = []
    while len(found) < n:
        center = rng.standard_normal(size)
        for _ in range(rng.integers(1, 12)):
            found.append(center * rng.uniform(0.1, 9) + rng.standard_normal(size) * rng.choice([0, 0.1, 0.4, 0.6]))
    return found[:n]


@pytest.mark.parametrize("size", [64, 7, 2, 1])
def test_all_pairs(spark, size):
    rng = np.random.default_rng(size)
    vectors = dict(enumerate(made(rng, 400, size)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df).collect()}
    assert got == brute(vectors)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(3)
    center = rng.standard_normal(32)
    vectors = {i: center + rng.standard_normal(32) * 0.25 for i in range(200)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df).collect()}
    assert got == brute(vectors)


def test_query_over_the_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    want = brute({r.vec_id: np.array(r.embedding, float) for r in rows})
    got = queries.QUERIES["op10_embeddings"](spark, sf_dir).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert len(got) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([
        (5, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (9, [2.0, 0.1], 1), (4, [1.0, 0.0, 0.0], 1),
        (1, None, 1), (2, [], 1), (6, [0.0, -0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (10, [None, 1.0], 1),
        (None, [0.0, 1.0], 1), (11, [-0.0, 1.0], 1), (12, [1e308, 1e308], 1), (13, [1e-308, 1e-308], 1)],
        "vec_id long, embedding array<double>, node int")
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == sorted([
        ("5", 3, 3, False), ("3", 3, 3, True), ("3", 3, 3, True), ("9", 3, 3, False), ("4", 0, 4, True), ("1", 0, 1, True),
        ("2", 0, 2, True), ("6", 0, 6, True), ("7", 0, 7, True), ("8", 0, 8, True), ("10", 0, 10, True),
        ("None", 1, 11, False), ("11", 1, 11, True), ("12", 1, 12, True), ("13", 1, 12, False)])
    assert near_duplicates(df.limit(0)).count() == 0


def test_recall_at_the_threshold_is_planned():
    for n in (1, 100, 10_000, 10**9):
        bits, tables = plan_tables(n)
        same = (1 - np.arccos(0.9) / np.pi) ** bits
        assert (1 - same) ** tables <= 1e-4
