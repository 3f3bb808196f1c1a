"""Filter interactions against counting document by document."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from tests_llm_compare import connection, differences

from snapmart.llm import queries
from snapmart.llm.filter_audit import audit, bit_counts, survival_words


def failures(rows):
    """Set of failed filters of each (doc_id, text)."""
    found = []
    for doc_id, text in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        smaller = [i for i, other in rows if (other or "") == t and i is not None and (doc_id is None or i < doc_id)]
        found.append({f for f, bad in (
            ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", t)) > 5 * len(t)), ("D", re.search(r"[#$%&*|]", t) is not None),
            ("E", bool(smaller))) if bad})
    return found


def brute(rows, labels):
    """Rows are (doc_id, text, source); applies every order to every document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failed = failures([r[:2] for r in rows])
    figures, shapley = Counter(), Counter()
    for (doc_id, _, source), f in zip(rows, failed):
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, name in enumerate(order, 1):
                key = (source or "", order, step)
                if name in f and gone:
                    figures[key, "redundant"] += 1
                elif name in f:
                    gone = True
                    figures[key, "removed"] += 1
                    figures[key, "good_lost"] += doc_id in good
                    figures[key, "toxic_lost"] += doc_id in toxic
                    shapley[source or "", name] += 1
                figures[key, "unique_fails"] += f == {name}
                figures[key, "kept"] += not gone
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {(p, o, s): (*[figures[(p, o, s), n] for n in names], shapley[p, o[s - 1]])
            for p in {r[2] or "" for r in rows} for o in map("".join, permutations("ABCDE")) for s in range(1, 6)}


def found(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 100, 4097])
def test_bits_are_counted(n):
    rng = np.random.default_rng(n)
    words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    assert bit_counts(words).tolist() == [int(((words >> b) & 1).sum()) for b in range(32)]


def test_survival_words():
    for m, word in enumerate(survival_words(np.arange(32))):
        assert [bool(int(word) >> s & 1) for s in range(32)] == [m & s == 0 for s in range(32)]


def test_made_documents(spark):
    rng, rows = random.Random(3), []
    for i in range(150):
        words = [rng.choice(["ab", "Cd", "E", "ff#", "é", "|"] if rng.random() < 0.3 else ["x%d" % rng.randrange(400)])
                 for _ in range(rng.choice([0, 3, 49, 50, 60]))]
        rows.append((i if rng.random() < 0.95 else None, rng.choice([None, "", " ".join(words), " ".join(words).upper(), "a " * 50]),
                     rng.choice(["s", "t", "", None])))
    rows += rows[:5]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in list(range(100)) * 2] + [(None, 1, 1)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, mask string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert found(audit(docs.repartition(3), marks)) == brute(rows, labels)


def test_limits_are_met_exactly(spark):
    distinct = [f"w{i}" for i in range(65)] + ["w0"] * 35
    texts = [" ".join(distinct), " ".join(distinct[:-1] + ["w0", "w0"]), " ".join(f"w{i}" for i in range(50)), "B" + "a" * 19,
             "B" + "a" * 18, " ".join(f"w{i}" for i in range(49))]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert found(audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))) == brute(rows, [])


def test_no_rows_and_a_long_text(spark):
    docs = spark.createDataFrame([(1, "word " * 400_000, None)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")
    rows = audit(docs, labels).where("filter_order = 'BACDE'").collect()
    assert [(r.step, r.removed, r.toxic_lost, r.shapley) for r in sorted(rows, key=lambda r: r.step)][0] == (1, 1, 1, 120)
    assert audit(docs.limit(0), labels).count() == 0


def test_query_over_the_whole_tables(spark, sf_dir):
    got = queries.QUERIES["op12_filter_audit"](spark, sf_dir)
    assert differences(got, connection(sf_dir), queries.SQL["op12_filter_audit"]) is None
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    assert found(got) == brute(docs, labels)
