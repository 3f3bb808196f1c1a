"""Suffix-array figures against counting by hand."""

import collections
import random
import re

import pytest

from snapmart.llm import queries
from snapmart.llm.quality import Limits, judge, keep_good, measure


def windows(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    counts = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if counts[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen = 0, set()
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(inside)


def repeats(text, least):
    words, inside, longest = (text or "").split(), set(), 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            n = 0
            while j + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            if n >= least:
                longest = max(longest, n)
                inside |= set(range(i, i + n)) | set(range(j, j + n))
    return len(inside), longest


def test_random_texts():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("a b c dd é".split()) for _ in range(rng.randrange(50))) + rng.choice(["", " x\n", " \n\n"])
             for _ in range(600)] + [None, "", " \n ", "a " * 300, "\x0b\x0ca\x1cb"]
    for least in (2, 4, 9):
        got = list(zip(*measure(texts, least)))
        for text, row in zip(texts, got):
            assert row[:5] == windows(text)
            assert (row[6], row[7]) == repeats(text, least), text


def test_base_figures_of_the_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_quality"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, chars, symbols, lines, repeat = windows(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeat)
        assert r.base_failed == (n < 20 or 100 * repeat > 30 * n)
        assert not (r.base_failed and r.kept)


def test_labelled_documents(spark, sf_dir):
    verdicts = queries.QUERIES["op9_quality"](spark, sf_dir)
    rows = verdicts.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert good and all(good)
    assert sum(bad) <= 0.1 * max(len(bad), 10)


def test_nulls_repeats_and_extra_columns(spark):
    good = " ".join(f"word{i}" for i in range(30))
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, good, None), (4, good, "c"), (4, good, "c")],
                               "doc_id long, text string, kept string")
    rows = judge(df).collect()
    assert sorted((r.n_words, r.kept) for r in rows) == [(0, False), (0, False), (30, True), (30, True), (30, True)]
    kept = keep_good(df)
    assert kept.columns == df.columns and kept.count() == 3
    assert judge(df.limit(0)).count() == 0 and keep_good(df.limit(0)).count() == 0


@pytest.mark.parametrize("text, verdict", [
    (" ".join(f"w{i}" for i in range(100)), True),
    (" ".join(f"w{i}###" for i in range(100)), False),
    (" ".join(f"W{i}!!" for i in range(100)), False),
    (" ".join(f"w{i // 5}" for i in range(200)), False),
])
def test_method_verdict(spark, text, verdict):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert judge(df, Limits()).first().kept is verdict
    assert keep_good(df).count() == int(verdict)
