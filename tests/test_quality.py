from decimal import Decimal

from snapmart.operators import quality


def broken(df, key, rules):
    return {tuple(r) for r in quality.check(df, [key], rules).collect()}


def test_entity_rules(spark):
    df = spark.createDataFrame(
        [(1, 1, "ok", Decimal("0.00")), (2, 2, "   ", Decimal("1.00")), (3, 3, "x", Decimal("-0.01")),
         (4, None, None, None)], "entity_id long, external_id long, name string, price decimal(10,2)")
    assert broken(df, "entity_id", quality.entity_rules()) == {
        (2, "name_not_blank"), (3, "price_not_negative"), (4, "external_id_not_null"), (4, "name_not_null"),
        (4, "price_not_null")}


def test_category_rules(spark):
    df = spark.createDataFrame([(1, "a"), (2, " ")], "category_id long, category_name string")
    assert broken(df, "category_id", quality.category_rules()) == {(2, "category_name_not_blank")}


def test_snapshot_rules(spark):
    df = spark.createDataFrame(
        [(1, 1, 5, 5, 0, "t"), (2, 1, 6, 5, 0, "t"), (3, 1, -1, 0, 0, "t"), (4, 1, 0, -1, -1, "t")],
        "snapshot_id long, entity_id long, current_count long, peak_count long, total_ratings long, recorded_at string")
    assert broken(df, "snapshot_id", quality.snapshot_rules()) == {
        (2, "peak_at_least_current"), (3, "current_not_negative"), (4, "peak_not_negative"),
        (4, "ratings_not_negative"), (4, "peak_at_least_current")}


def test_rating_rules(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 1, Decimal("50.00"), "Mixed"), (2, 2, -1, -1, Decimal("100.01"), "Fine"),
         (3, 3, 0, 0, Decimal("0.00"), None)],
        "rating_id long, entity_id long, positive long, negative long, positive_pct decimal(5,2), label string")
    assert broken(df, "rating_id", quality.rating_rules()) == {
        (2, "positive_not_negative"), (2, "negative_not_negative"), (2, "percent_in_range"), (2, "label_known")}


def test_audit_rules(spark):
    df = spark.createDataFrame([(1, "d", "t", "MERGE", "x", "u")],
                               "audit_id long, database_name string, table_name string, operation string, "
                               "logged_at string, user_name string")
    assert broken(df, "audit_id", quality.audit_rules()) == {(1, "operation_known")}


def test_split_valid(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "long")], "id long, name string")
    valid, rejected = quality.split_valid(df, [*quality.not_null("name"), quality.max_length("name", 2)])
    assert [r["id"] for r in valid.collect()] == [1]
    assert {(r["id"], r["reasons"]) for r in rejected.collect()} == {(2, "name_not_null"), (3, "name_length")}


def test_unique_and_foreign_keys(spark):
    df = spark.createDataFrame([(1, "Acción"), (2, "accion"), (3, "x"), (3, "y")], "id long, name string")
    assert {tuple(r) for r in quality.unique_violations(df, ["id"]).collect()} == {(3, 2)}
    assert quality.unique_violations(df, ["name"]).count() == 0
    assert quality.unique_violations(df, ["name"], "es_CI_AI_RTRIM").first()["rows"] == 2
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "ref long")
    assert [r["ref"] for r in quality.fk_violations(child, "ref", df, "id").collect()] == [9, 9]
