from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapmart.operators import changes, quality, sync
from snapmart.operators.changes import ForeignKey
from snapmart.operators.filters import with_defaults

SCHEMA = "id long, ext long, name string, price decimal(10,2), made timestamp_ntz, changed timestamp_ntz"
ARGS = (["ext"], ["name", "price"])


def target(spark):
    return spark.createDataFrame([(1, 10, "a", Decimal("1.00"), None, None), (2, 20, "b", Decimal("2.00"), None, None)],
                                 SCHEMA)


def source(spark):
    return spark.createDataFrame([(20, "B", Decimal("3.00")), (40, "d", None), (30, "c", Decimal("0.50"))],
                                 "ext long, name string, price decimal(10,2)")


def rows(df, *columns):
    return sorted(df.select(*columns).collect())


def test_upsert(spark):
    result = changes.upsert(target(spark), source(spark), *ARGS, "2024-01-01 00:00:00", "id", "made", "changed")
    assert [(r["id"], r["ext"], r["name"]) for r in result.orderBy("id").collect()] == [
        (1, 10, "a"), (2, 20, "B"), (3, 30, "c"), (4, 40, "d")]
    stamps = {r["ext"]: (r["made"] is not None, r["changed"] is not None) for r in result.collect()}
    assert stamps == {10: (False, False), 20: (False, True), 30: (True, True), 40: (True, True)}


def test_upsert_twice_is_once(spark):
    args = (*ARGS, "2024-01-01 00:00:00", "id", "made", "changed")
    first = changes.upsert(target(spark), source(spark), *args)
    second = changes.upsert(first, source(spark), *args)
    assert rows(first, "id", "ext", "name", "changed") == rows(second, "id", "ext", "name", "changed") or \
        first.exceptAll(second).count() == 0 == second.exceptAll(first).count()


def test_update_to_null(spark):
    update = spark.createDataFrame([(20, None, None)], "ext long, name string, price decimal(10,2)")
    result = changes.upsert(target(spark), update, *ARGS)
    assert result.where("ext = 20").first()["name"] is None


def test_empty_target_and_empty_source(spark):
    nothing = target(spark).limit(0)
    assert [r["id"] for r in changes.upsert(nothing, source(spark), *ARGS, id_col="id").orderBy("ext").collect()] == [1, 2, 3]
    assert changes.upsert(target(spark), source(spark).limit(0), *ARGS, id_col="id").count() == 2


def test_last_and_first_by_key(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "k int, n int, v string")
    assert rows(changes.last_by_key(df, ["k"], ["n"]), "v") == [("y",), ("z",)]
    assert rows(changes.first_by_key(df, ["k"], ["n"]), "v") == [("x",), ("z",)]


def test_dimension(spark):
    dim = spark.createDataFrame([(1, "Acción")], "id long, name string")
    names = spark.createDataFrame([("accion",), ("Rol",), ("rol ",), ("Niño",), ("nino",), (None,), ("x" * 150,)],
                                  "name string")
    plain = changes.ensure_dimension(dim, names, "id", "name")
    assert plain.count() == 7 and plain.agg(F.max(F.length("name"))).first()[0] == 100
    loose = changes.ensure_dimension(dim, names, "id", "name", collation="es_CI_AI_RTRIM")
    got = {r["id"]: r["name"] for r in loose.collect()}
    assert got[1] == "Acción" and sorted(got) == list(range(1, len(got) + 1))
    assert sorted(n for n in got.values() if n[0] in "rR") == ["Rol"]
    assert len([n for n in got.values() if n.lower().startswith("ni")]) == 2  # ñ is a letter of its own


def test_replace_children(spark):
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 3)], "p long, c long")
    pairs = spark.createDataFrame([(1, 5), (1, 5)], "p long, c long")
    touched = spark.createDataFrame([(1,), (3,)], "p long")
    assert rows(changes.replace_children(bridge, pairs, "p", touched), "p", "c") == [(1, 5), (2, 1)]
    assert rows(changes.replace_children(bridge, pairs, "p"), "p", "c") == [(1, 5), (2, 1), (3, 3)]


def family(spark):
    return {
        "entity": spark.createDataFrame([(1,), (2,), (3,)], "entity_id long"),
        "order": spark.createDataFrame([(10, 1), (11, 2), (12, None)], "order_id long, entity_id long"),
        "line": spark.createDataFrame([(100, 10), (101, 11), (102, 12)], "line_id long, order_id long"),
    }


KEYS = [ForeignKey("order", "entity_id", "entity", "entity_id"), ForeignKey("line", "order_id", "order", "order_id")]


def test_cascade_delete_reaches_grandchildren(spark):
    gone = spark.createDataFrame([(1,)], "entity_id long")
    left = changes.cascade_delete(family(spark), KEYS, "entity", gone, "entity_id")
    assert rows(left["entity"], "entity_id") == [(2,), (3,)]
    assert {r[0] for r in left["order"].select("order_id").collect()} == {11, 12}
    assert rows(left["line"], "line_id") == [(101,), (102,)]
    for fk in KEYS:
        assert quality.fk_violations(left[fk.child], fk.column, left[fk.parent], fk.key).count() == 0


def test_cascade_rekey(spark):
    mapping = spark.createDataFrame([(1, 91)], "old_key long, new_key long")
    moved = changes.cascade_rekey(family(spark), KEYS, "entity", "entity_id", mapping)
    assert rows(moved["entity"], "entity_id") == [(2,), (3,), (91,)]
    assert {tuple(r) for r in moved["order"].collect()} == {(10, 91), (11, 2), (12, None)}


def test_defaults(spark):
    df = spark.createDataFrame([(None, None), ("x", Decimal("2.00"))], "name string, price decimal(10,2)")
    got = with_defaults(df, {"name": "none", "price": 0})
    assert {tuple(r) for r in got.collect()} == {("none", Decimal("0.00")), ("x", Decimal("2.00"))}
    assert got.schema["price"].dataType == df.schema["price"].dataType


def test_a_key_twice_in_the_source_is_refused(spark):
    target = spark.createDataFrame([(1, "a")], "id long, name string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "id long, name string")
    with pytest.raises(Exception, match="a key is twice in the source"):
        changes.merge(target, source, ["id"], ["name"]).collect()


def test_tables_that_refer_in_a_circle_are_refused(spark):
    a = spark.createDataFrame([(1, 2)], "id long, other long")
    circle = [ForeignKey("b", "other", "a", "id"), ForeignKey("a", "other", "b", "id")]
    for keys in (circle, [ForeignKey("a", "other", "a", "id")]):
        with pytest.raises(ValueError, match="circle"):
            changes.cascade_delete({"a": a, "b": a}, keys, "a", a.select("id"), "id")


def test_rekey_goes_down_all_levels_and_delete_waits_for_all_parents(spark):
    tables = {n: spark.createDataFrame([(1, 1), (2, 2)], "id long, ref long") for n in "abcd"}
    keys = [ForeignKey("b", "id", "a", "id"), ForeignKey("c", "ref", "b", "id"), ForeignKey("d", "ref", "c", "id"),
            ForeignKey("d", "id", "a", "id")]
    mapping = spark.createDataFrame([(1, 9)], "old_key long, new_key long")
    moved = changes.cascade_rekey(tables, keys[:2], "a", "id", mapping)
    assert sorted(tuple(r) for r in moved["c"].collect()) == [(1, 9), (2, 2)]
    left = changes.cascade_delete(tables, keys, "a", spark.createDataFrame([(1,)], "id long"), "id")
    assert all([tuple(r) for r in left[n].collect()] == [(2, 2)] for n in "abcd")


def test_sync_modes():
    assert [sync.check_mode(m) for m in ("full", "Incremental")] == ["FULL", "INCREMENTAL"]
    with pytest.raises(ValueError, match="PARTIAL"):
        sync.check_mode("PARTIAL")


def test_recent_changes_in_one_join(spark):
    """A key that the target holds twice, and none, send a row once; a change without a time is not lately."""
    columns = "key long, name string, changed timestamp_ntz"
    late, early = datetime(2024, 1, 2), datetime(2023, 1, 1)
    sent = [(1, "late", late), (2, "early", early), (3, "untimed", None), (4, "new", early), (5, "new", None), (None, "no key", early)]
    known = spark.createDataFrame([(k,) for k in (1, 1, 2, 3, None)], "key long")
    found = sync.recent_changes(spark.createDataFrame(sent, columns), known, "key", "changed", "2024-01-02 12:00:00")
    assert {tuple(r)[1:] for r in found.select("changed", "name", "is_new").collect()} == {
        ("late", False), ("new", True), ("no key", True)}
    assert found.count() == 4
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
