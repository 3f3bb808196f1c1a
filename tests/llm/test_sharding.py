"""The tree's laws, places in shards, and the SQL form."""

import zlib
from collections import Counter, defaultdict

from snapmart.llm import queries
from snapmart.llm.sharding import even_tree, grown, shard_of, shard_rows, shard_sql
from tests_llm_compare import connection


def test_rows_of_the_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op7_sharding"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        body = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(body) + 1, zlib.crc32(body), "key")
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_only_the_new_shard_gains_and_shares_are_even(spark):
    keys = spark.range(20_000)
    for n in (8, 9, 10):
        tree = even_tree(8)
        for _ in range(n - 8):
            tree = grown(tree)
        rows = keys.select(shard_of(keys.id, tree).alias("a"), shard_of(keys.id, grown(tree)).alias("b")).collect()
        assert all(r.b in (r.a, n) for r in rows)
        counts = Counter(r.b for r in rows)
        assert all(abs(counts[s] * (n + 1) / 20_000 - 1) < 0.15 for s in range(n + 1))


def test_movement_stays_in_subtrees_whose_weight_changed(spark):
    keys = spark.range(20_000)
    tree = even_tree(8)
    heavier = {**tree, "g1": {**tree["g1"], "r3": {6: 1.0, 7: 3.0}}}
    rows = keys.select(shard_of(keys.id, tree).alias("a"), shard_of(keys.id, heavier).alias("b")).collect()
    moved = [(r.a, r.b) for r in rows if r.a != r.b]
    assert moved and all(b in (4, 5, 6, 7) for _, b in moved)
    assert not any(a in (0, 1, 2, 3) and b in (0, 1, 2, 3) for a, b in moved)
    assert not any(a in (4, 5) and b in (4, 5) for a, b in moved)


def test_sql_gives_the_same_shards(spark, sf_dir):
    tree = even_tree(8)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {(r.doc_id, r.s) for r in docs.select("doc_id", shard_of(docs.doc_id, tree).alias("s")).collect()}
    want = connection(sf_dir).execute(f"SELECT doc_id, {shard_sql('doc_id', tree)} FROM documents").fetchall()
    assert got == set(want)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, 1)] * 3 + [(1, "", 2)] + [(7, "é", 3)] * 9000, "doc_id long, text string, shard int")
    rows = shard_rows(df, even_tree(8)).collect()
    assert len(rows) == 9004
    assert {(r.doc_id, r.size) for r in rows} == {(None, 1), (1, 1), (7, 3)}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_rows(df.limit(0), even_tree(8)).count() == 0
