"""Pairwise preferences: the fit against a plain descent, the scores against held-out labels."""

import zlib

import numpy as np

from snapmart.llm import preference, queries
from snapmart.llm.preference import ACCEPT, FEATURES, bradley_terry, features, fit, learn, predict, quantile_limit, score_rows


def test_fit_is_the_least_loss():
    rng = np.random.default_rng(3)
    better, worse = rng.normal(0.3, 1, (400, 3)), rng.normal(0, 1, (400, 3))
    got, apart, w = bradley_terry(better, worse, penalty=0.1), better - worse, np.zeros(3)
    for _ in range(4000):
        wrong = 1 / (1 + np.exp(apart @ w))
        w -= 0.5 * (-(apart * wrong[:, None]).mean(axis=0) + 0.1 * w)
    assert np.allclose(got, w, atol=1e-5)


def test_limit_is_the_quantile():
    scores = np.array([5.0, 1.0, 3.0, 2.0])
    assert quantile_limit(scores, np.ones(4), 0.5) == 2.5
    assert quantile_limit(scores, np.array([1.0, 8.0, 1.0, 1.0]), 8 / 11) == 1.5
    assert quantile_limit(scores, np.ones(4), 1.0) == 5.0


def test_features_of_odd_texts():
    for text in (None, "", " \n ", "a", "A", "###", "é" * 10, "word " * 100_000, "\x0b\x1c", "1 2\n1 2"):
        row = features(text)
        assert len(row) == len(FEATURES) and np.isfinite(row).all()
    assert features(None) == features("")
    named = dict(zip(FEATURES, features("AB# ab\n\nAB# ab\n!")))
    assert named["repeated_lines"] == 1 / 3 and named["symbols"] == 2 / 5 and named["marked_words"] == 3 / 5
    assert named["shouted"] == 2 / 5 and named["distinct"] == 3 / 5 and named["repeated_pairs"] == 1 - 3 / 4


def test_scores_follow_preferences_and_the_limit():
    rng = np.random.default_rng(4)
    good, bad = rng.normal(1, 0.2, (300, len(FEATURES))), rng.normal(0, 0.2, (50, len(FEATURES)))
    model = fit(good, bad, 3000, 500)
    s_good, s_bad = score_rows(good, model), score_rows(bad, model)
    assert s_good.min() >= ACCEPT > s_bad.max() and 0 <= s_bad.min() and s_good.max() <= 1
    assert fit(good, bad[:0], 10, 0) is None
    far = score_rows(np.full((1, len(FEATURES)), 1e12), model)
    assert np.isfinite(far).all()


def auc(scores, good):
    order = np.argsort(np.argsort(scores, kind="stable")) + 1
    n = good.sum()
    return (order[good].sum() - n * (n + 1) / 2) / (n * (len(good) - n))


def test_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = queries.QUERIES["op13_preference"](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    good = np.array([r.quality == 1 for r in rows])
    scores, predicted = np.array([r.score for r in rows]), np.array([r.predicted == 1 for r in rows])
    assert len(rows) > 60 and 0 < good.sum() < len(good)
    assert auc(scores, good) >= 0.97 and (predicted == good).mean() >= 0.95
    assert (predicted == (scores >= 0.7)).all()


def test_every_row_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.QUERIES["op13_preference"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    turned = spark.createDataFrame(
        [(r.doc_id, 1 - r.quality if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else r.quality) for r in labels.collect()],
        "doc_id long, quality int")
    assert learn(docs, labels) == learn(docs, turned)


def test_odd_rows(spark):
    good, bad = [" ".join(f"word{j}x{i}" for j in range(40)) for i in range(40)], ["BAD!! ### | " * 20] * 20
    texts = good + bad + [None, "", "x" * 300_000]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)] + [(None, "null id", 0.0), (0, good[0], 1.0)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame(
        [(i, 1 if i < 40 else 0) for i in range(60)] + [(3, 1), (3, 0), (4, None), (None, 1), (9999, 0), (5, 7)],
        "doc_id long, quality int")
    model = learn(docs, labels)
    rows = predict(docs, model).collect()
    assert len(rows) == len(texts) + 2 and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.predicted for r in rows}
    assert all(by_id[i] == 1 for i in range(40)) and not any(by_id[i] for i in range(40, 60))
    assert learn(docs, labels.where("quality = 1")) is None and learn(docs.limit(0), labels) is None
    assert {r.score for r in predict(docs, None).collect()} == {0.5}
    assert predict(docs.limit(0), model).count() == 0


def test_sample_is_bounded_and_counts_are_whole(spark, sf_dir, monkeypatch):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    asked = {}
    monkeypatch.setattr(preference, "fit", lambda good, bad, n_good, n_bad: asked.update(
        sizes=(len(good), len(bad)), counts=(n_good, n_bad)))
    learn(docs, labels, per_label=5)
    kept = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    assert asked["sizes"] == (5, 5)
    assert asked["counts"] == (sum(r.quality == 1 for r in kept), sum(r.quality == 0 for r in kept))


def test_every_labelled_document_takes_part(spark):
    """More of each label than any sample held, and few of one label: the figures of all give means and limit."""
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 9 > 3), " ".join("ab" if x else "AB#" for x in rng.random(12) < (0.6 if i % 9 > 3 else 0.45)))
            for i in range(9000)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    for kept in (rows, [r for r in rows if r[1] or r[0] % 300 == 0]):
        labels = spark.createDataFrame([(i, q) for i, q, _ in kept], "doc_id long, quality int")
        model = learn(docs, labels)
        taught = [(q, features(t)) for i, q, t in kept if zlib.crc32(str(i).encode()) % 4 != 2]
        figures, bad = np.array([f for _, f in taught]), sum(q == 0 for q, _ in taught)
        assert np.allclose(model.means, figures.mean(axis=0), atol=1e-9)
        raw = np.sort(preference.standard(figures, model) @ np.array(model.weights))
        assert abs(model.limit - (raw[bad - 1] + raw[bad]) / 2) < 1e-9
