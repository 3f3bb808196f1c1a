from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapmart.functions import scalars


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, expected", [
    ("May 13, 2020", date(2020, 5, 13)),
    ("may 3, 2020", date(2020, 5, 3)),
    ("13 May, 2020", date(2020, 5, 13)),
    ("  03 Jan, 2021 ", date(2021, 1, 3)),
    ("September 9, 2019", date(2019, 9, 9)),
    ("9 September, 2019", date(2019, 9, 9)),
    ("2018-07-06", date(2018, 7, 6)),
    ("2020", date(2020, 1, 1)),
    ("Feb  1, 2022", date(2022, 2, 1)),
    ("Feb 30, 2022", None),
    ("Q1 2025", None),
    ("Coming Soon", None),
    ("", None),
    (None, None),
])
def test_parse_date(spark, text, expected):
    assert one(spark, scalars.parse_date(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("positive, negative, expected", [
    (2, 1, "66.67"), (1, 0, "100.00"), (0, 0, "0.00"), (0, 5, "0.00"), (1, 799, "0.13"), (None, None, "0.00"),
])
def test_rating_percent(spark, positive, negative, expected):
    votes = scalars.rating_percent(F.lit(positive).cast("long"), F.lit(negative).cast("long"))
    assert one(spark, votes) == Decimal(expected)


@pytest.mark.parametrize("label, band, short", [
    ("Very Positive", "rating-pos", "Muy Pos."),
    ("Overwhelmingly Negative", "rating-neg", "Overwhelm-"),
    ("Mixed", "rating-mix", "Mixto"),
    ("No user reviews", "rating-mix", "No user reviews"),
    ("", "", "—"),
    (None, "", "—"),
])
def test_labels(spark, label, band, short):
    text = F.lit(label).cast("string")
    assert one(spark, scalars.rating_band(text)) == band
    assert one(spark, scalars.short_label(text)) == short


def test_allowed_label(spark):
    assert one(spark, scalars.allowed_label(F.lit("Mixed"))) == "Mixed"
    assert one(spark, scalars.allowed_label(F.lit("3 user reviews"))) is None


@pytest.mark.parametrize("unit, start, end, expected", [
    ("SECOND", "2024-01-01 00:00:00.9", "2024-01-01 00:00:01.1", 1),
    ("SECOND", "2024-01-01 00:00:00.1", "2024-01-01 00:00:00.9", 0),
    ("SECOND", "2024-01-01 00:00:01.1", "2024-01-01 00:00:00.9", -1),
    ("MILLISECOND", "2024-01-01 00:00:00.0009", "2024-01-01 00:00:00.0011", 1),
    ("DAY", "2023-12-31 23:59:59", "2024-01-01 00:00:00", 1),
    ("SECOND", "1969-12-31 23:59:59.5", "1970-01-01 00:00:00.5", 1),
])
def test_boundaries(spark, unit, start, end, expected):
    assert one(spark, scalars.boundaries_between(unit, scalars.timestamp(start), scalars.timestamp(end))) == expected


def test_percent_change(spark):
    assert one(spark, scalars.percent_change(F.lit(150), F.lit(100))) == Decimal("50.0")
    assert one(spark, scalars.percent_change(F.lit(150), F.lit(0))) is None


def test_freshness_limit(spark):
    now = scalars.timestamp("2024-01-01 12:10:00")
    assert one(spark, scalars.freshness(scalars.timestamp("2024-01-01 12:00:00"), now)) == "INACTIVO"
    assert one(spark, scalars.freshness(scalars.timestamp("2024-01-01 12:00:01"), now)) == "ACTIVO"
    assert one(spark, scalars.freshness(F.lit(None).cast("timestamp_ntz"), now)) is None


def test_small_texts(spark):
    assert one(spark, scalars.price_text(F.lit(Decimal("0.00")))) == "Free"
    assert one(spark, scalars.price_text(F.lit(Decimal("9.90")))) == "$9.90"
    assert one(spark, scalars.clock_text(F.lit(63000))) == "06:30"
    assert one(spark, scalars.clock_text(F.lit(0))) == "00:00"
    assert one(spark, scalars.clock_text(F.lit(235959))) == "23:59"
    assert one(spark, scalars.cents_to_price(F.lit(1999))) == Decimal("19.99")
    assert one(spark, scalars.cents_to_price(F.lit(None).cast("long"))) == Decimal("0.00")
    assert one(spark, scalars.megabytes(F.lit(1572864))) == Decimal("1.50")
    assert one(spark, scalars.listed(F.lit('["name","price"]'))) == "name, price"
    assert one(spark, scalars.listed(F.lit(None).cast("string"))) == "—"
    assert one(spark, scalars.joined(F.array(F.lit("a"), F.lit("b")))) == "a, b"
    assert one(spark, scalars.joined(F.array().cast("array<string>"))) is None
    assert one(spark, scalars.iso_text(scalars.timestamp("2024-01-02 03:04:05"))) == "2024-01-02T03:04:05"
    assert one(spark, scalars.iso_text(scalars.timestamp("2024-01-02 03:04:05.5"))) == "2024-01-02T03:04:05.500000"
    assert one(spark, scalars.compact_stamp(scalars.timestamp("2024-01-02 03:04:05"))) == "20240102_030405"
    assert one(spark, scalars.decode(F.lit("Z"), {"D": "FULL"})) is None
    assert one(spark, scalars.decode(F.lit(4), {4: "Diario"}, "?")) == "Diario"


def test_recent(spark):
    now = scalars.timestamp("2024-01-02 00:00:00")
    assert one(spark, scalars.is_recent(scalars.timestamp("2024-01-01 00:00:00"), now)) is True
    assert one(spark, scalars.is_recent(scalars.timestamp("2023-12-31 23:59:59.999999"), now)) is False


def test_now_is_utc(spark):
    from datetime import datetime, timezone
    shown = one(spark, scalars.timestamp(None))
    assert abs((shown - datetime.now(timezone.utc).replace(tzinfo=None)).total_seconds()) < 60
    assert isinstance(one(spark, scalars.day(None)), date)


def test_collated_predicates(spark):
    from snapmart.functions import scalars
    from snapmart.operators import filters, quality
    texts = ["Mixed", "MIXED", "mixed  ", "Míxed", "Mixed up", " Mixed", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string")

    def kept(found):
        return sorted(r.n for r in found.collect())

    ci = "es_CI_AI_RTRIM"
    assert kept(filters.filter_equal(df, "t", "Mixed")) == [0]
    assert kept(filters.filter_equal(df, "t", "mixed", ci)) == [0, 1, 2, 3]
    assert kept(filters.filter_in(df, "t", ["Mixed", "x"])) == [0] and kept(filters.filter_in(df, "t", ["x", "MÍXED "], ci)) == [0, 1, 2, 3]
    assert kept(filters.filter_in(df, "t", [], ci)) == []
    assert kept(filters.filter_prefix(df, "t", "Mixed")) == [0, 4] and kept(filters.filter_prefix(df, "t", "mÍx", ci)) == [0, 1, 2, 3, 4]
    got = df.select("n", scalars.allowed_label("t").alias("a"), scalars.allowed_label("t", collation=ci).alias("b")).collect()
    assert [r.a for r in got] == ["Mixed"] + [None] * 7
    assert [r.b for r in got] == texts[:4] + [None] * 4
    bands = spark.createDataFrame([("very positive",), ("Very Positive",), ("",)], "t string").select(
        scalars.rating_band("t"), scalars.rating_band("t", ci)).collect()
    assert bands[0][0] != bands[1][0] and bands[0][1] == bands[1][1] == bands[1][0] and bands[2][0] == bands[2][1]
    rows = df.select(*[c.alias(n) for n, c in {
        "rating_id": F.col("n"), "entity_id": F.col("n"), "positive": F.lit(1), "negative": F.lit(1),
        "positive_pct": F.lit(50), "label": F.col("t")}.items()])
    assert {r.rating_id for r in quality.check(rows, ["rating_id"], quality.rating_rules()).collect()} == {1, 2, 3, 4, 5, 6}
    assert {r.rating_id for r in quality.check(rows, ["rating_id"], quality.rating_rules(collation=ci)).collect()} == {4, 5, 6}
    log = spark.createDataFrame([("d", "t", "insert", 1, "u")], "database_name string, table_name string, operation string, "
                                "logged_at int, user_name string")
    assert quality.check(log, ["operation"], quality.audit_rules()).count() == 1
    assert quality.check(log, ["operation"], quality.audit_rules(ci)).count() == 0
