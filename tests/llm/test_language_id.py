"""Held-out accuracy, and odd texts."""

import zlib

from snapmart.llm import queries
from snapmart.llm.language_id import learn, predict


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op5_language"](spark, sf_dir).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es", "und"} for r in rows)
    right = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert sum(right) / len(right) >= 0.95


def test_nothing_is_learned_from_held_out_or_unlabelled_rows(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    other = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, "geheim wort", "de") for i in held] + [(i, "plain words here", "en") for i in other[:50]]
    rows += [(i, "mots secrets", None) for i in other[50:]]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [name for name, _ in model] == ["en"]
    assert b"geheim" not in model[0][1] and b"mots" not in model[0][1]


def test_odd_rows(spark):
    train = [(i, f"the cat sat on the mat number {i}", "en") for i in range(40)]
    train += [(100 + i, f"der hund lief durch den garten {i}", "de") for i in range(20)]
    model = learn(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "123 ... !!", "x"), (None, "the cat sat", "x"), (4, "DER HUND", "x"),
                                (4, "DER HUND", "x"), (5, "的", "x"), (6, "der hund lief " * 50_000, "x")],
                               "doc_id long, text string, score string")
    rows = sorted(((str(r.doc_id), r.lang_pred) for r in predict(df, model).collect()))
    assert rows == [("1", "und"), ("2", "und"), ("3", "und"), ("4", "de"), ("4", "de"), ("5", "en"), ("6", "de"), ("None", "en")]
    assert {r.lang_pred for r in predict(df, []).collect()} == {"und"}
    assert predict(df.limit(0), model).count() == 0
    assert learn(spark.createDataFrame([], "doc_id long, text string, lang string")) == []
