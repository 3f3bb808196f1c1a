import json
from datetime import datetime

import pytest

from snapmart.operators import audit

SCHEMA = "id long, name string, price decimal(10,2), born date"
TRACKED = ["name", "price", "born"]


def frame(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(i, n, None if p is None else Decimal(p), b) for i, n, p, b in rows], SCHEMA)


def fields(spark, before, after, **options):
    return audit.changed_fields(frame(spark, before), frame(spark, after), "id", TRACKED, **options).first()[0]


def test_changed_fields(spark):
    assert fields(spark, [(1, "a", "1.00", None)], [(1, "b", "2.00", None)]) == '["name","price"]'
    assert fields(spark, [(1, "a", "1.00", None), (2, "x", "1.00", None)],
                  [(1, "a", "2.00", None), (2, "y", "1.00", None)]) == '["name","price"]'
    assert fields(spark, [(1, None, "1.00", None)], [(1, "", "1.00", None)]) is None
    assert fields(spark, [(1, "a", None, None)], [(1, "a", "1.00", None)]) is None
    assert fields(spark, [(1, "a", "1.00", None)], [(2, "b", "1.00", None)]) is None
    assert fields(spark, [], []) is None


def test_date_appears(spark):
    from datetime import date
    assert fields(spark, [(1, "a", "1.00", None)], [(1, "a", "1.00", date(2020, 1, 1))]) == '["born"]'


def test_case_and_accent_are_a_matter_of_collation(spark):
    before, after = [(1, "Acción", "1.00", None)], [(1, "accion ", "1.00", None)]
    assert fields(spark, before, after) == '["name"]'
    assert fields(spark, before, after, collation="es_CI_AI_RTRIM") is None


def test_long_form_counts_rows(spark):
    before = frame(spark, [(1, "a", "1.00", None), (2, "b", "1.00", None)])
    after = frame(spark, [(1, "x", "1.00", None), (2, "y", "3.00", None)])
    got = {(r["field"], r["rows_changed"]) for r in audit.changed_fields_long(before, after, "id", TRACKED).collect()}
    assert got == {("name", 2), ("price", 1)}


def test_changed_rows(spark):
    before = frame(spark, [(1, "a", "1.00", None), (2, "b", "1.00", None), (3, "c", "1.00", None)])
    after = frame(spark, [(1, "x", "1.00", None), (3, "c", "1.00", None), (4, "d", "1.00", None)])
    got = {tuple(r) for r in audit.changed_rows(before, after, "id", TRACKED).collect()}
    assert got == {(1, "UPDATE", '["name"]'), (2, "DELETE", None), (4, "INSERT", None)}


@pytest.mark.parametrize("before, after, operation", [
    ([], [(1, "a", "1.00", None)], "INSERT"),
    ([(1, "a", "1.00", None)], [], "DELETE"),
    ([(1, "a", "1.00", None)], [(1, "b", None, None)], "UPDATE"),
])
def test_one_row_and_its_header(spark, before, after, operation):
    rows = audit.audit_rows(frame(spark, before), frame(spark, after), "id", TRACKED, "entity", "shop",
                            "2024-01-01 00:00:00", "me", audit_id=7)
    row, header = rows.first(), audit.audit_headers(rows, TRACKED).first()
    assert (row["row_key"], row["operation"], row["logged_at"], row["user_name"]) == ("1", operation, datetime(2024, 1, 1), "me")
    for image, given in (("before_row", before), ("after_row", after)):
        # null fields are left out
        want = {n for n, v in zip(("id", "name", "price", "born"), given[0]) if v is not None} if given else None
        assert (set(json.loads(row[image])) if row[image] else None) == want
    assert (row["changed_fields"] is not None) == (operation == "UPDATE")
    assert (header["audit_id"], header["operation"], header["rows_before"], header["rows_after"]) == (
        7, operation, len(before), len(after))


def test_empty_batch_is_not_logged(spark):
    nothing = frame(spark, [])
    rows = audit.audit_rows(nothing, nothing, "id", TRACKED, "entity", "shop")
    assert rows.count() == 0 and audit.audit_headers(rows, TRACKED).count() == 0


@pytest.mark.parametrize("size", [1, 1000, 1001])
def test_the_form_does_not_depend_on_the_size(spark, size):
    before = frame(spark, [(i, "a", "1.00", None) for i in range(size)])
    after = frame(spark, [(i, "b", "1.00", None) for i in range(size // 2, size + size // 2)])
    rows = audit.audit_rows(before, after, "id", TRACKED, "entity", "shop")
    assert rows.count() == size + size // 2
    assert rows.where("before_row IS NOT NULL").count() == rows.where("after_row IS NOT NULL").count() == size
    headers = audit.audit_headers(rows, TRACKED).collect()
    assert [(h["rows_before"], h["rows_after"], h["changed_fields"]) for h in headers] == [(size, size, '["name"]')]


def test_tail_without_changes(spark):
    rows = [(1, "d", "t", "INSERT", datetime(2024, 1, 1), "u", None), (2, "d", "t", "UPDATE", datetime(2024, 1, 2), "u", '["a","b"]')]
    log = spark.createDataFrame(rows, "audit_id long, database_name string, table_name string, operation string, "
                                      "logged_at timestamp_ntz, user_name string, changed_fields string")
    assert [(r["audit_id"], r["changed_text"]) for r in audit.audit_tail(log, 2).collect()] == [(2, "a, b"), (1, "—")]
    assert [r["audit_id"] for r in audit.audit_tail(log, 1).collect()] == [2]


def test_images_keep_microseconds(spark):
    after = spark.createDataFrame([(1, datetime(2024, 1, 1, 0, 0, 0, 123456)), (2, datetime(2024, 1, 1))],
                                  "id long, at timestamp_ntz")
    rows = audit.audit_rows(after.limit(0), after, "id", [], "t", "d").orderBy("row_key").collect()
    assert [json.loads(r["after_row"])["at"] for r in rows] == ["2024-01-01T00:00:00.123456", "2024-01-01T00:00:00"]


def logged_rows(spark, rows):
    """Rows are (audit_id, row_key, before, after)."""
    return spark.createDataFrame(
        [(a, "d", "t", datetime(2024, 1, 1), "u", k, "X", b, n, None) for a, k, b, n in rows],
        "audit_id long, database_name string, table_name string, logged_at timestamp_ntz, user_name string, row_key string, "
        "operation string, before_row string, after_row string, changed_fields string")


def documents(spark, rows, **options):
    parts = audit.statement_documents(logged_rows(spark, rows), **options).orderBy("audit_id", "part").collect()
    return [(r["audit_id"], r["part"], r["rows_before"], r["rows_after"], r["before_rows"], r["after_rows"]) for r in parts]


def test_a_small_statement_is_one_document(spark):
    rows = [(1, "10", '{"k":10}', '{"k":10,"v":1}'), (1, "9", None, '{"k":9}'), (2, "1", None, '{"k":1}'), (3, "x", '{"k":"x"}', None)]
    assert documents(spark, rows) == [
        (1, 1, 1, 2, '[{"k":10}]', '[{"k":9},{"k":10,"v":1}]'), (2, 1, 0, 1, None, '[{"k":1}]'), (3, 1, 1, 0, '[{"k":"x"}]', None)]
    assert documents(spark, []) == []
    assert documents(spark, [(1, "1", None, None)]) == [(1, 1, 0, 0, None, None)]


@pytest.mark.parametrize("chunks", [1, 5])
def test_a_large_statement_is_cut_by_bytes(spark, chunks):
    rows = [(7, str(i), None if i % 3 == 0 else json.dumps({"k": i}), json.dumps({"k": i, "é": "ñ" * (i % 5)}, ensure_ascii=False))
            for i in range(500)] + [(7, "1000", None, '{"v":"' + "x" * 5000 + '"}'), (8, "0", None, '{"k":0}')]
    want, part, full = {}, 0, 0
    for a, k, b, n in rows[:-1]:
        want.setdefault(full // 1000, []).append((b, n))
        full += len((b or "").encode()) + len((n or "").encode())
    got = documents(spark, rows, max_bytes=1000, chunks=chunks)
    assert [g[1] for g in got] == [*range(1, len(want) + 1), 1]
    for (_, part, n_before, n_after, before, after), number in zip(got, sorted(want)):
        b, n = ([x for x in side if x is not None] for side in zip(*want[number]))
        assert (n_before, n_after) == (len(b), len(n))
        assert before == ("[" + ",".join(b) + "]" if b else None) and after == ("[" + ",".join(n) + "]" if n else None)
        assert json.loads(after) == [json.loads(x) for x in n]
