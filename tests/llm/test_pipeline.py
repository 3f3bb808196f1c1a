"""The stages one after the other, on the driver's documents and on made ones."""

import random

import corpus_pipeline as pipeline
import pytest


def stages_of(spark, docs, sf_dir, folder):
    found = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found[name] = docs
    return found


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = random.Random(8)

    def text(n):
        return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" for _ in range(n))

    clean = [text(rng.randrange(40, 200)) for _ in range(120)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(clean)]
    near = clean[5].split()
    near[:9] = [w.upper() for w in near[:9]]
    rows += [(500, "  ".join(near), "en", "s0", 1), (501, clean[6], "en", "s1", 1), (502, clean[6], "en", "s1", 1)]
    rows += [(600, "too short", "en", "s0", 9), (601, "spam spam spam " * 40, "en", "s0", 9), (602, None, None, None, None)]
    rows += [(700, text(60) + ' token = "0123456789abcdef0123456789abcdef" end', "en", "s2", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return rows, stages_of(spark, docs, "", str(tmp_path_factory.mktemp("stages")))


def test_columns_and_rows(made):
    rows, found = made
    for name in list(found)[:-1]:
        assert found[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {n: [r.doc_id for r in f.select("doc_id").collect()] for n, f in found.items()}
    assert sorted(ids["quality"]) == sorted(set(r[0] for r in rows) - {600, 601, 602})
    assert sorted(ids["near_duplicates"]) == sorted(set(ids["quality"]) - {500, 501, 502})
    assert sorted(ids["secrets"]) == sorted(ids["near_duplicates"])
    assert set(ids["mixing"]) <= set(ids["secrets"])
    assert sorted(ids["encoding"]) == sorted(ids["mixing"])


def test_secrets_are_masked_and_lengths_follow(made):
    _, found = made
    row = found["secrets"].where("doc_id = 700").first()
    assert "0123456789abcdef" not in row.text and "[secret]" in row.text
    assert found["secrets"].where("n_chars <> length(text)").count() == 0


def test_every_text_decodes_again(made):
    _, found = made
    assert found["encoding"].where("NOT decodes OR n_tokens <> size(ids)").count() == 0


def test_run_over_the_driver_tables(spark, sf_dir):
    rows = pipeline.run(spark, sf_dir)
    assert rows.count() > 50 and rows.where("NOT decodes").count() == 0


def test_nulls_in_every_column_extra_columns_and_no_rows(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" for _ in range(80)) for _ in range(6)]
    rows = [(1, texts[0], None, None, None, "a", None), (None, texts[1], "en", "s", 5, None, 1), (3, texts[2], "en", "s", 5, "b", 2),
            (3, texts[2], "en", "s", 5, "b", 2), (4, None, "en", None, 0, "c", 3), (5, "", None, "s", 0, "d", 4),
            (None, texts[3] + " " + " ".join(f"x{i}" for i in range(30_000)), None, "t", 1, "e", 5)]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, __body string, __position long")
    docs = spark.createDataFrame(rows, schema)
    found = stages_of(spark, docs, "", str(tmp_path / "odd"))
    for name in list(found)[:-1]:
        assert found[name].columns == docs.columns
    left = found["mixing"].select("__body", "__position").distinct().collect()
    # a copy of the equal rows went; both rows without an id stay, since their texts differ
    assert sorted((r[0] or "", r[1]) for r in left if r[1]) == [("", 1), ("b", 2), ("e", 5)]
    assert found["encoding"].where("NOT decodes").count() == 0
    empty = stages_of(spark, docs.limit(0), "", str(tmp_path / "none"))
    assert all(df.count() == 0 for df in empty.values())
