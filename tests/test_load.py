"""Loading polls, in batch and as a stream, and synchronising the result."""

import json
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapmart.operators import quality
from snapmart.operators.latest import latest_per_group
from snapmart.plans.load import Feeds, load_batch
from snapmart.plans.sync_job import sync_tables
from snapmart.schema import BRIDGE, LANDED, SNAPSHOT
from snapmart.sources.lake import ADDED_IN, BATCH, Keyed, Lake, layout
from snapmart.streaming import jobs

T1, T2 = datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 12, 5)


def detail(name, price=None, genres=(), makers=("M",)):
    data = {"name": name, "short_description": "d", "developers": list(makers), "publishers": ["P"],
            "genres": [{"description": g} for g in genres], "release_date": {"date": "2020"}}
    if price is not None:
        data["price_overview"] = {"final": price}
    return data


def poll(at, ranks, details, ratings=None, current=None):
    """Landing rows of one poll."""
    rows = [(at, "ranking", None, {"response": {"ranks": [
        {"appid": a, "concurrent_in_game": c, "peak_in_game": p} for a, c, p in ranks]}})]
    rows += [(at, "details", a, {str(a): {"success": d is not None, "data": d or {}}}) for a, d in details.items()]
    rows += [(at, "ratings", a, {"success": 1, "query_summary": {
        "total_positive": p, "total_negative": n, "review_score_desc": label}}) for a, (p, n, label) in (ratings or {}).items()]
    rows += [(at, "current", a, {"response": {"result": 1, "player_count": c}}) for a, c in (current or {}).items()]
    return [(t, f, a, json.dumps(b)) for t, f, a, b in rows]


FIRST = poll(T1, [(10, 100, 150), (20, 80, 60), (30, 5, 5), (40, 1, 1)],
             {10: detail("Ten", 999, ["RPG", "Indie", "RPG"]), 20: detail("Twenty", None, ["Indie"]), 30: None,
              40: detail("Long", 1, makers=("x" * 300,))},
             {10: (2, 1, "Mixed"), 20: (0, 0, "No user reviews")}, {10: 120})
SECOND = poll(T2, [(20, 90, 95), (50, 7, 9)],
              {20: detail("Twenty", 500, ["Action"]), 50: detail("Fifty", 100, ["Action"])}, {20: (9, 1, "Positive")})


def landed(spark, rows):
    return Feeds.landed(spark.createDataFrame(rows, LANDED))


def content(lake):
    return {
        "entity": {(r["entity_id"], r["external_id"], r["name"], str(r["price"])) for r in lake.read("entity").collect()},
        "bridge": {tuple(r) for r in lake.read("bridge").join(lake.read("category"), "category_id")
                   .select("entity_id", "category_name").collect()},
        "snapshot": {(r["snapshot_id"], r["entity_id"], r["current_count"], r["peak_count"], r["total_ratings"],
                      r["recorded_at"]) for r in lake.read("snapshot").collect()},
        "rating": {(r["entity_id"], r["positive"], r["negative"], str(r["positive_pct"]), r["label"])
                   for r in lake.read("rating").collect()},
    }


@pytest.fixture(scope="module")
def first_folder(spark, tmp_path_factory):
    """A lake after the first load, to be copied."""
    folder = str(tmp_path_factory.mktemp("first") / "lake")
    load_batch(Lake(spark, folder, layout(4)), landed(spark, FIRST), 0, "2024-01-01 12:01:00")
    return folder


def copy_of(folder, tmp_path):
    return shutil.copytree(folder, tmp_path / "copied")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")), layout(4))
    first = load_batch(lake, landed(spark, FIRST), 0, "2024-01-01 12:01:00").first()
    after_first = content(lake)
    second = load_batch(lake, landed(spark, SECOND), 1, "2024-01-01 12:06:00").first()
    return lake, first, after_first, second


def test_first_load(loaded):
    _, tally, after, _ = loaded
    assert (tally["loaded"], tally["skipped"], tally["rejected"]) == (2, 1, 1)
    assert (tally["entities_inserted"], tally["entities_updated"], tally["snapshots_inserted"]) == (2, 0, 2)
    assert after["entity"] == {(1, 10, "Ten", "9.99"), (2, 20, "Twenty", "0.00")}
    assert after["bridge"] == {(1, "RPG"), (1, "Indie"), (2, "Indie")}
    assert after["snapshot"] == {(1, 1, 120, 150, 3, T1), (2, 2, 80, 80, 0, T1)}
    assert after["rating"] == {(1, 2, 1, "66.67", "Mixed"), (2, 0, 0, "0.00", None)}


def test_second_load(loaded):
    lake, _, _, tally = loaded
    after = content(lake)
    assert (tally["entities_inserted"], tally["entities_updated"], tally["categories_inserted"]) == (1, 1, 1)
    assert after["entity"] == {(1, 10, "Ten", "9.99"), (2, 20, "Twenty", "5.00"), (3, 50, "Fifty", "1.00")}
    assert after["bridge"] == {(1, "RPG"), (1, "Indie"), (2, "Action"), (3, "Action")}
    assert len(after["snapshot"]) == 4 and {s[0] for s in after["snapshot"]} == {1, 2, 3, 4}
    assert (2, 9, 1, "90.00", "Positive") in after["rating"]
    times = {r["external_id"]: (r["created_at"], r["updated_at"]) for r in lake.read("entity").collect()}
    assert times[20] == (datetime(2024, 1, 1, 12, 1), datetime(2024, 1, 1, 12, 6))
    assert times[10] == (datetime(2024, 1, 1, 12, 1), datetime(2024, 1, 1, 12, 1))


def test_stored_tables_keep_their_constraints(loaded):
    lake = loaded[0]
    assert quality.check(lake.read("entity"), ["entity_id"], quality.entity_rules()).count() == 0
    assert quality.check(lake.read("snapshot"), ["snapshot_id"], quality.snapshot_rules()).count() == 0
    assert quality.check(lake.read("rating"), ["rating_id"], quality.rating_rules()).count() == 0
    assert quality.check(lake.read("audit"), ["audit_id"], quality.audit_rules()).count() == 0
    for table, keys in (("entity", ["external_id"]), ("entity", ["entity_id"]), ("bridge", ["entity_id", "category_id"]),
                        ("rating", ["entity_id"]), ("audit", ["audit_id"])):
        assert quality.unique_violations(lake.read(table), keys).count() == 0
    for child in ("bridge", "snapshot", "rating"):
        assert quality.fk_violations(lake.read(child), "entity_id", lake.read("entity"), "entity_id").count() == 0


def test_audit_of_the_loads(loaded):
    lake = loaded[0]
    log = [(r["table_name"], r["operation"], r["changed_fields"]) for r in lake.read("audit").orderBy("audit_id").collect()]
    assert log == [("entity", "INSERT", None), ("snapshot", "INSERT", None), ("entity", "INSERT", None),
                   ("entity", "UPDATE", '["price"]'), ("snapshot", "INSERT", None)]
    assert {r["reasons"] for r in lake.read("quarantine").collect()} == {"maker_length"}


def test_a_batch_that_runs_again_changes_nothing(spark, loaded):
    lake = loaded[0]
    before, log = content(lake), sorted(map(str, lake.read("audit_row").collect()))
    again = load_batch(lake, landed(spark, SECOND), 1, "2024-01-01 12:06:00").first()
    assert content(lake) == before and sorted(map(str, lake.read("audit_row").collect())) == log
    assert again == loaded[3]


class Dying(Lake):
    dies_at = ""

    def _write(self, table, rows, folders):
        if table == self.dies_at:
            raise InterruptedError(table)
        super()._write(table, rows, folders)


@pytest.mark.parametrize("table", ["audit", "entity", "category", "snapshot", "quarantine"])
def test_a_batch_that_died_is_run_again(spark, loaded, first_folder, tmp_path, table):
    lake = Dying(spark, str(copy_of(first_folder, tmp_path)), layout(4))
    lake.dies_at = table
    with pytest.raises(InterruptedError):
        load_batch(lake, landed(spark, SECOND), 1, "2024-01-01 12:06:00")
    lake.dies_at = ""
    load_batch(lake, landed(spark, SECOND), 1, "2024-01-01 12:06:00")
    assert content(lake) == content(loaded[0])
    for name in ("audit", "audit_row", "quarantine"):
        assert sorted(map(str, lake.read(name).collect())) == sorted(map(str, loaded[0].read(name).collect()))


def test_half_a_rewrite_is_run_again(spark, first_folder, tmp_path):
    """Only some buckets were put in place when the batch died: new rows get the ids they had."""
    lake = Lake(spark, str(copy_of(first_folder, tmp_path)), layout(4))
    many = poll(T2, [(i, i, i) for i in range(100, 120)], {i: detail(f"N{i}", 1) for i in range(100, 120)})
    load_batch(lake, landed(spark, many), 1, "2024-01-01 12:06:00")
    whole = content(lake)
    bucket = lake.rows("entity").where(f"{ADDED_IN} LIKE '%1'").select(lake.bucket_of("entity")).first()[0]
    lake.rewrite("entity", lake.rows("entity", [bucket]).where(f"{ADDED_IN} NOT LIKE '%1'"), [bucket])
    assert content(lake) != whole
    load_batch(lake, landed(spark, many), 1, "2024-01-01 12:06:00")
    assert content(lake) == whole


def test_ids_go_on_behind_a_sync(spark, loaded, tmp_path):
    lake = Lake(spark, str(tmp_path), layout(4))
    sync_tables(source_of(loaded[0]), lake, "b0", "FULL")
    new = poll(T2, [(60, 1, 1)], {60: detail("Sixty", 5, ["Racing"])}, {60: (1, 0, "Positive")})
    load_batch(lake, landed(spark, new), 1)
    for table, key, rows in (("entity", "entity_id", 4), ("category", "category_id", 4), ("snapshot", "snapshot_id", 5),
                             ("rating", "rating_id", 3)):
        ids = [r[0] for r in lake.read(table).select(key).collect()]
        assert len(ids) == len(set(ids)) == rows, table


def test_bad_documents_do_not_stop_the_others(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), layout(4))
    rows = poll(T1, [(i, 1, 1) for i in range(1, 8)], {1: detail("One", 1), 2: detail("Two", 10**13), 3: detail("Three", 1, [" "]),
                                                        4: detail("Four", 1), 7: detail("Seven", 1)},
                {4: (2**63 - 1, 5, "Mixed"), 7: (4 * 10**17, 1, "Mixed")})
    rows += [(T1, "details", 5, json.dumps({"x5": {"success": True, "data": detail("Five", 1)}})), (T1, "details", 6, "{broken")]
    load_batch(lake, landed(spark, rows), 0)
    assert {r["name"] for r in lake.read("entity").collect()} == {"One", "Seven"}
    assert {(r["external_id"], r["reasons"]) for r in lake.read("quarantine").collect()} == {
        (2, "price_readable"), (3, "category_name_not_blank"), (4, "ratings_readable"), (5, "details_key_readable"),
        (6, "details_readable")}
    assert str(lake.read("rating").where("positive > 5").first()["positive_pct"]) == "100.00"


def test_two_polls_in_one_batch(spark, loaded, tmp_path):
    lake = Lake(spark, str(tmp_path), layout(4))
    load_batch(lake, landed(spark, FIRST + SECOND), 0)
    both, apart = content(lake), content(loaded[0])
    # the same rows, only the ids are given out in another order
    assert {e[1:] for e in both["entity"]} == {e[1:] for e in apart["entity"]}
    assert {s[2:] for s in both["snapshot"]} == {s[2:] for s in apart["snapshot"]}
    assert {r[1:] for r in both["rating"]} == {r[1:] for r in apart["rating"]}


def test_stream_equals_batch(spark, loaded, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    lake = Lake(spark, str(tmp_path / "lake"), layout(4))

    def arrive(name, rows):
        lines = [json.dumps({"polled_at": t.isoformat(), "feed": f, "external_id": a, "body": b}) for t, f, a, b in rows]
        (landing / name).write_text("\n".join(lines))

    def run():
        jobs.stream_load(lake, str(landing), str(tmp_path / "ck"), jobs.ONCE, 1).awaitTermination(300)

    arrive("1.json", FIRST)
    run()
    assert content(lake) == loaded[2]
    arrive("2.json", SECOND)
    run()
    run()
    assert content(lake) == content(loaded[0])


def test_buckets_emptied_and_kept(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), layout(4))
    assert lake.read("bridge").count() == 0 and lake.read("snapshot").columns[-1] == "recorded_date"
    rows = spark.range(200).selectExpr("id AS entity_id", "id AS category_id")
    lake.rewrite("bridge", rows)
    touched = lake.touched("bridge", rows.where("entity_id = 7"))
    old = lake.rows("bridge", touched).count()
    assert lake.read("bridge").count() == 200 and 0 < old < 200
    # rows of other buckets may be read while one is written
    lake.rewrite("bridge", lake.rows("bridge", touched).where("entity_id < 0"), touched)
    assert lake.read("bridge").count() == 200 - old
    assert lake.rows("bridge", touched).count() == 0


def test_a_series_takes_a_batch_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), layout(4))
    rows = spark.range(1, 5).selectExpr("id AS category_id", "CAST(id AS STRING) AS category_name")
    for batch in ("a", "b", "a"):
        lake.add("category", rows, batch)
    assert lake.read("category").count() == 8
    assert lake.earlier("category", "a").count() == 4 and lake.highest({"category": "category_id", "audit": "audit_id"}, "b") == {"category": 4, "audit": 0}
    assert {r[0] for r in lake.rows("category").select(BATCH).collect()} == {"a", "b"}


def source_of(lake):
    return {t: lake.read(t) for t in ("category", "entity", "bridge", "rating", "snapshot")}


def same(a, b):
    return content(a) == content(b)


def test_sync_full_and_incremental_agree(spark, loaded, tmp_path):
    source = loaded[0]
    full = Lake(spark, str(tmp_path / "full"), layout(4))
    done = sync_tables(source_of(source), full, "b0", "FULL").first()
    assert (done["entity_rows"], done["snapshot_rows"], done["mode"]) == (3, 4, "FULL")
    assert same(full, source)
    sync_tables(source_of(source), full, "b1", "full")
    assert same(full, source)

    steps = Lake(spark, str(tmp_path / "steps"), layout(4))
    early = {"category": "category_id <= 2", "entity": "entity_id <= 1", "bridge": "entity_id <= 1",
             "rating": "rating_id <= 1", "snapshot": "snapshot_id <= 2"}
    sync_tables({t: df.where(early[t]) for t, df in source_of(source).items()}, steps, "b0")
    done = sync_tables(source_of(source), steps, "b1").first()
    assert same(steps, source)
    assert (done["entity_rows"], done["snapshot_rows"]) == (2, 2)
    assert (done["inserted_rows"], done["updated_rows"]) == (done["total_rows"], 0)
    nothing = sync_tables(source_of(source), steps, "b2").first()
    assert nothing["total_rows"] == 0 and same(steps, source)


def test_sync_by_change_time_sees_updates(spark, loaded, tmp_path):
    source = loaded[0]
    lake = Lake(spark, str(tmp_path), layout(4))
    old = source_of(source)
    old["entity"] = old["entity"].withColumn("name", old["entity"]["publisher"])
    sync_tables(old, lake, "b0", "FULL")
    sync_tables(source_of(source), lake, "b1", by="max_key")
    assert {r["name"] for r in lake.read("entity").collect()} == {"P"}
    done = sync_tables(source_of(source), lake, "b2", by="changed_since", as_of="2024-01-02 12:03:00").first()
    assert (done["entity_rows"], done["inserted_rows"], done["updated_rows"]) == (2, 0, 2)
    # the entity last changed at 12:01 the day before stays as it was
    assert {r["name"] for r in lake.read("entity").collect()} == {"P", "Twenty", "Fifty"}


def test_modes(spark, loaded, tmp_path):
    lake = Lake(spark, str(tmp_path), layout(4))
    with pytest.raises(ValueError):
        sync_tables(source_of(loaded[0]), lake, "b0", "PARTIAL")
    with pytest.raises(ValueError):
        sync_tables(source_of(loaded[0]), lake, "b0", by="guess")


def test_sync_to_a_database(spark, loaded, monkeypatch):
    """The steps of a copy, with a dictionary in place of the database."""
    from snapmart.plans import sync_job
    source, copy, calls = source_of(loaded[0]), {}, []
    keys = {s.table: s.watermark for s in sync_job.ORDER}

    def write(df, options, mode="append"):
        rows, table = [tuple(r) for r in df.select(keys[options["dbtable"]]).collect()], options["dbtable"]
        calls.append((mode, table))
        copy[table] = rows if mode == "overwrite" else copy.get(table, []) + rows
        return len(rows)

    def read(spark, options, columns=None):
        if columns:  # the unique values that are there
            there = source[options["dbtable"]]
            return there.where(F.col(keys[options["dbtable"]]).isin([r[0] for r in copy.get(options["dbtable"], [])])).select(*columns)
        assert "dbtable" not in options and "COALESCE(MAX(" in options["query"]
        table = options["query"].rsplit(" ", 1)[1]
        return spark.createDataFrame([(max([r[0] for r in copy.get(table, [])], default=0),)], "max_key long")

    monkeypatch.setattr(sync_job, "write_jdbc", write)
    monkeypatch.setattr(sync_job, "read_table", read)
    targets = {table: {"url": "jdbc:x", "dbtable": table} for table in keys}
    early = {t: df.where(f"{keys[t]} <= 1") for t, df in source.items()}
    sync_job.sync_jdbc(early, targets)
    done = sync_job.sync_jdbc(source, targets).first()
    assert {t: len(rows) for t, rows in copy.items()} == {t: df.count() for t, df in source.items()}
    assert done["entity_rows"] == 2 and done["total_rows"] == sum(df.count() for df in source.values()) - sum(
        df.count() for df in early.values())
    assert sync_job.sync_jdbc(source, targets).first()["total_rows"] == 0
    calls.clear()
    sync_job.sync_jdbc(source, targets, "FULL")
    assert [t for m, t in calls if m == "overwrite"] == ["snapshot", "rating", "bridge", "entity", "category"]
    assert {t: len(rows) for t, rows in copy.items()} == {t: df.count() for t, df in source.items()}


def test_a_stream_that_died_goes_on(spark, tmp_path):
    path = str(tmp_path / "in")
    table = write_parts(spark, path)

    class Failing(Lake):
        tries = 0

        def _write(self, table, rows, folders):
            super()._write(table, rows, folders)
            self.tries += 1
            if self.tries == 2:  # the rows are there, but the stream does not know
                raise OSError("lost")

    lake = Failing(spark, str(tmp_path / "copy"), layout(4))

    def run():
        jobs.stream_sync(jobs.file_stream(spark, path, SNAPSHOT, 1), lake, str(tmp_path / "ck"),
                         trigger=jobs.ONCE).awaitTermination(300)

    with pytest.raises(Exception, match="lost"):
        run()
    assert lake.read("snapshot").count() == 12
    run()
    copied = lake.read("snapshot").select(table.columns)
    assert copied.count() == 30 and copied.exceptAll(table).count() == 0


def test_a_stream_that_starts_anew_at_the_same_path_is_another_one(spark, tmp_path):
    path = str(tmp_path / "in")
    write_parts(spark, path)
    lake = Lake(spark, str(tmp_path / "copy"), layout(4))
    for turn in range(2):
        jobs.stream_sync(jobs.file_stream(spark, path, SNAPSHOT, 1), lake, str(tmp_path / "ck"),
                         trigger=jobs.ONCE).awaitTermination(300)
        (tmp_path / "ck").rename(tmp_path / f"old{turn}")
    assert lake.read("snapshot").count() == 60


def write_parts(spark, path):
    rows = [(i, i % 3, i * 10, i * 10, i, datetime(2024, 1, 1, 0, i)) for i in range(1, 31)]
    for part in (rows[:10], rows[10:12], rows[12:]):
        spark.createDataFrame(part, SNAPSHOT).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(SNAPSHOT).parquet(path)


def test_stream_latest_equals_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    table = write_parts(spark, path)
    lake = Lake(spark, str(tmp_path / "out"), {"latest": Keyed(SNAPSHOT, "entity_id", 4)})
    stream = jobs.file_stream(spark, path, SNAPSHOT, 1)
    ck = str(tmp_path / "ck")
    query = jobs.stream_latest(stream, "entity_id", ["recorded_at", "snapshot_id"],
                               jobs.into(lake, ck, jobs.latest_into("latest")), ck, jobs.ONCE)
    query.awaitTermination(300)
    want = latest_per_group(table, "entity_id", ["recorded_at", "snapshot_id"]).drop("recency")
    names = SNAPSHOT.fieldNames()
    assert sorted(lake.read("latest").select(names).collect()) == sorted(want.select(names).collect())


def test_stream_sync_and_audit(spark, tmp_path):
    path = str(tmp_path / "in")
    table = write_parts(spark, path)
    lake = Lake(spark, str(tmp_path / "copy"), layout(4))
    for _ in range(2):
        jobs.stream_sync(jobs.file_stream(spark, path, SNAPSHOT, 1), lake, str(tmp_path / "ck"),
                         trigger=jobs.ONCE).awaitTermination(300)
    copied = lake.read("snapshot").select(table.columns)
    assert copied.count() == 30 and copied.exceptAll(table).count() == 0

    jobs.stream_audit(jobs.file_stream(spark, path, SNAPSHOT, 1), lake, str(tmp_path / "ck2"), "snapshot_id",
                      ["current_count"], "snapshot", trigger=jobs.ONCE).awaitTermination(300)
    log = lake.read("audit").collect()
    assert {r["operation"] for r in log} == {"INSERT"} and len({r["audit_id"] for r in log}) == len(log) == 3
    rows = lake.read("audit_row").collect()
    assert sorted(json.loads(r["after_row"])["snapshot_id"] for r in rows) == list(range(1, 31))
    assert {r["audit_id"] for r in rows} == {r["audit_id"] for r in log}
    # both streams write the same lake and none loses a batch
    extra = spark.createDataFrame([(31, 1, 1, 1, 1, datetime(2024, 1, 2))], SNAPSHOT)
    extra.coalesce(1).write.mode("append").parquet(path)
    jobs.stream_sync(jobs.file_stream(spark, path, SNAPSHOT, 1), lake, str(tmp_path / "ck"),
                     trigger=jobs.ONCE).awaitTermination(300)
    assert lake.read("snapshot").count() == 31


def test_command_line(spark, tmp_path, capsys):
    from snapmart import __main__ as cli
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.json").write_text("\n".join(json.dumps(
        {"polled_at": t.isoformat(), "feed": f, "external_id": a, "body": b}) for t, f, a, b in FIRST))
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    cli.main(["--buckets", "4", "load", "--landing", str(landing), "--lake", first, "--progress", str(tmp_path / "p"), "--once"])
    cli.main(["--buckets", "4", "sync", "--source", first, "--lake", second, "--mode", "FULL", "--batch", "first"])
    assert same(Lake(spark, first, layout(4)), Lake(spark, second, layout(4)))
    cli.main(["--buckets", "4", "report", "--lake", first])
    assert "Twenty" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["sync", "--lake", first])


def test_a_poll_without_items(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), layout(4))
    tally = load_batch(lake, landed(spark, poll(T1, [], {}) + poll(T2, [(1, 2, 3)], {})), 0).first()
    assert (tally["loaded"], tally["skipped"], tally["rejected"]) == (0, 1, 0)
    assert lake.read("entity").count() == 0 == lake.read("audit").count()


CHANGES = "entity_id long, category_id long, change_kind string, seq int"


def change_stream(spark, lake, tmp_path, rounds, **options):
    spec = Keyed(BRIDGE, "entity_id", 4)
    lake.tables["pairs"] = spec
    for rows in rounds:
        spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        jobs.stream_changes(jobs.file_stream(spark, str(tmp_path / "in"), CHANGES), lake, str(tmp_path / "ck"), "pairs", ["seq"],
                            ["category_id"], as_of="2024-01-01 00:00:00", trigger=jobs.ONCE, **options).awaitTermination(300)


def logged(lake):
    return sorted((r["audit_id"], r["row_key"], r["operation"], r["before_row"], r["after_row"]) for r in lake.read("audit_row").collect())


ROUNDS = [[(1, 10, "put", 1), (2, 20, "put", 1), (3, 30, "put", 1), (9, 9, "delete", 1)],
          [(1, 11, "put", 1), (1, 12, "put", 2), (2, 20, "put", 1), (3, 0, "delete", 1), (4, 40, "put", 1), (5, 5, "put", 1),
           (5, 5, "delete", 2)]]


def image(key, value):
    return json.dumps({"entity_id": key, "category_id": value}, separators=(",", ":"))


WANT = [(1, "1", "INSERT", None, image(1, 10)), (1, "2", "INSERT", None, image(2, 20)), (1, "3", "INSERT", None, image(3, 30)),
        (2, "4", "INSERT", None, image(4, 40)), (3, "1", "UPDATE", image(1, 10), image(1, 12)), (4, "3", "DELETE", image(3, 30), None)]


def test_changes_are_applied_and_logged_by_kind(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), layout(4))
    change_stream(spark, lake, tmp_path, ROUNDS)
    assert sorted(map(tuple, lake.read("pairs").collect())) == [(1, 12), (2, 20), (4, 40)]
    assert logged(lake) == WANT
    heads = [(r["audit_id"], r["operation"], r["rows_before"], r["rows_after"], r["changed_fields"])
             for r in lake.read("audit").orderBy("audit_id").collect()]
    assert heads == [(1, "INSERT", 0, 3, None), (2, "INSERT", 0, 1, None), (3, "UPDATE", 1, 1, '["category_id"]'),
                     (4, "DELETE", 1, 0, None)]


@pytest.mark.parametrize("table", ["audit_row", "audit", "pairs"])
def test_changes_that_died_are_applied_once(spark, tmp_path, table):
    lake = Dying(spark, str(tmp_path / "lake"), layout(4))
    change_stream(spark, lake, tmp_path, ROUNDS[:1])
    lake.dies_at = table
    with pytest.raises(Exception, match=table):
        change_stream(spark, lake, tmp_path, ROUNDS[1:])
    lake.dies_at = ""
    jobs.stream_changes(jobs.file_stream(spark, str(tmp_path / "in"), CHANGES), lake, str(tmp_path / "ck"), "pairs", ["seq"],
                        ["category_id"], as_of="2024-01-01 00:00:00", trigger=jobs.ONCE).awaitTermination(300)
    assert sorted(map(tuple, lake.read("pairs").collect())) == [(1, 12), (2, 20), (4, 40)]
    assert logged(lake) == WANT


def test_changes_need_a_keyed_table(spark, tmp_path):
    with pytest.raises(ValueError, match="no keyed table"):
        jobs.stream_changes(None, Lake(spark, str(tmp_path)), "x", "snapshot", [], [])


def test_a_clash_updates_or_is_ignored(spark, loaded, tmp_path):
    lake, source = Lake(spark, str(tmp_path), layout(4)), source_of(loaded[0])
    sync_tables(source, lake, "b0", "FULL")
    clash = dict(source)
    again = source["entity"].where("entity_id = 2").withColumns({"entity_id": F.lit(90), "name": F.lit("Again")})
    clash["entity"] = source["entity"].unionByName(again)
    clash["rating"] = source["rating"].unionByName(source["rating"].where("entity_id = 1").withColumns(
        {"rating_id": F.lit(90), "positive": F.lit(77)}))
    clash["category"] = source["category"].unionByName(source["category"].where("category_name = 'RPG'").withColumn(
        "category_id", F.lit(90)))
    for batch in ("b1", "b1", "b2"):
        done = sync_tables(clash, lake, batch).first()
        assert (done["inserted_rows"], done["updated_rows"]) == (0, 2)
        found = {r["entity_id"]: r["name"] for r in lake.read("entity").collect()}
        assert found == {1: "Ten", 2: "Again", 3: "Fifty"}
        assert {r["rating_id"]: r["positive"] for r in lake.read("rating").collect()}[1] == 77
        assert lake.read("category").count() == 3


class Watched(Lake):
    """Keeps the plans of what is written."""

    def __init__(self, *args):
        super().__init__(*args)
        self.plans = {}

    def _write(self, table, rows, folders):
        self.plans[table] = rows._jdf.queryExecution().optimizedPlan().toString()
        super()._write(table, rows, folders)


def test_documents_are_read_once(spark, tmp_path):
    lake = Watched(spark, str(tmp_path), layout(2))
    rows = poll(T1, [(1, 1, 1), (2, 2, 2)], {1: detail("One", 1)}, {1: (1, 0, "Positive")})
    rows += [(T1, "details", 2, "{broken"), (T1, "details", 3, json.dumps({"x3": {"success": True, "data": detail("Three", 1)}}))]
    load_batch(lake, landed(spark, rows), 0)
    assert {(r["external_id"], r["reasons"]) for r in lake.read("quarantine").collect()} == {
        (2, "details_readable"), (3, "details_key_readable")}
    assert not [t for t in ("entity", "rating", "quarantine") if "from_json" in lake.plans[t]]


def test_rows_behind_the_watermark_are_not_looked_up(spark, loaded, tmp_path):
    lake, source = Watched(spark, str(tmp_path), layout(4)), source_of(loaded[0])
    parts = {t: df.where("entity_id = 1") if "entity_id" in df.columns else df for t, df in source.items()}
    sync_tables(parts, lake, "b0", "FULL")
    for _ in range(2):
        done = sync_tables(source, lake, "b1").first()
        assert done["bridge_rows"] == source["bridge"].where("entity_id > 1").count() > 0 and done["updated_rows"] == 0
        assert "Join" not in lake.plans["bridge"]
        assert sorted(map(tuple, lake.read("bridge").collect())) == sorted(map(tuple, source["bridge"].select("entity_id", "category_id").collect()))
