"""Fingerprints and groups against brute force."""

import random

import pytest
import xxhash

from snapmart.llm import queries
from snapmart.llm.components import components
from snapmart.llm.simhash import fingerprint, fingerprint_groups, meeting_links, one_of_each_group

MASK = 2**64 - 1


def brute_fingerprint(text, size=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    runs = [words] if 0 < len(words) < size else [words[i:i + size] for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def test_fingerprints():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["Ab", "c", "É", "zz\x1c", "q\u00a0r"]) for _ in range(rng.randrange(12))) for _ in range(300)]
    for t in texts + [None, "", "one", "One  two", " \n\t "]:
        assert fingerprint(t) & MASK == brute_fingerprint(t), t


def test_spark_hash_is_the_same(spark):
    row = spark.sql("SELECT xxhash64('one two three') AS h").first()
    assert row.h & MASK == xxhash.xxh64_intdigest(b"one two three", 42)


@pytest.mark.parametrize("bits, base", [(64, 0), (48, 5 << 48)])
def test_links_within_two_bits(spark, bits, base):
    rng = random.Random(bits)
    centers = [rng.getrandbits(bits) for _ in range(30)]
    keys = set()
    for c in centers:
        keys.add(c)
        for _ in range(rng.randrange(60)):
            x = rng.choice([c, rng.choice(sorted(keys))])
            for b in rng.sample(range(bits), rng.randrange(4)):
                x ^= 1 << b
            keys.add(x)
    keys |= {0, 1, 3, 1 << (bits - 1)}
    signed = [(k | base) - (1 << 64 if (k | base) >> 63 else 0) for k in sorted(keys)]
    linked = components(meeting_links(spark.createDataFrame([(k,) for k in signed], "key long"), bits)).collect()
    roots = {r.node: r.root for r in linked}
    want = groups(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & MASK).bit_count() <= 2])
    assert {k: roots.get(k, k) for k in signed} == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(300)] + [(7, 7), (5, 4), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges if None not in e for x in e})
    want = groups(nodes, [e for e in edges if None not in e])
    assert {n: got.get(n, n) for n in nodes} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_over_the_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: brute_fingerprint(t) for i, t in docs.items()}
    ids = sorted(docs)
    want = groups(ids, [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    rows = queries.QUERIES["op3_simhash"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{prints[i]:016x}", want[i]) for i in ids}
    assert len(rows) == len(ids)


def test_groups_of_odd_rows(spark):
    df = spark.createDataFrame([(3, None, 1), (2, "", 2), (None, " ", 3), (9, "same text here", 4), (9, "same text here", 4),
                                (None, "only this one", 5)], "doc_id long, text string, fp int")
    rows = sorted((str(r.doc_id), str(r.component_id)) for r in fingerprint_groups(df).collect())
    assert rows == [("2", "2"), ("3", "2"), ("9", "9"), ("9", "9"), ("None", "2"), ("None", "None")]
    assert fingerprint_groups(df.limit(0)).count() == 0


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(4000)}" for _ in range(n)]


def brute_kept(texts):
    prints = [brute_fingerprint(t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    return set(groups(range(len(texts)), links).values())


def test_one_of_each_group_stays(spark):
    rng, texts = random.Random(11), []
    for _ in range(60):
        own = words(rng, rng.choice([60, 150, 400]))
        texts.append(" ".join(own))
        for _ in range(rng.randrange(6)):
            copy = list(own)
            for at in rng.sample(range(len(copy)), int(len(copy) * rng.choice([0, 0.005, 0.015, 0.1]))):
                copy[at] = "changed" + str(rng.randrange(1000))
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    texts += ["", None, " \n"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, __digest string")
    kept = one_of_each_group(df)
    assert kept.columns == df.columns
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got) == sorted(brute_kept(texts)) and len(got) < len(texts) - 20


def test_one_of_each_group_of_odd_rows(spark):
    own = words(random.Random(12), 120)
    rows = [(900, " ".join(own)), (901, " ".join(own).upper()), (900, " ".join(own)), (None, None), (None, ""),
            (7, "other words here"), (7, "other words here"), (7, "and yet another text"), (None, "only this one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text or "") for r in one_of_each_group(df).collect())
    assert got == sorted([("900", " ".join(own)), ("None", ""), ("7", "other words here"), ("7", "and yet another text"),
                          ("None", "only this one")])
    assert one_of_each_group(df.limit(0)).count() == 0
