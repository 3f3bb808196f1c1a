"""What the plans must and must not contain, at any size of the data."""

import re
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import __spark_entry__ as driver  # noqa: E402
from compare import connection, differences  # noqa: E402
from snapmart import Roles, Tables, driver_tables  # noqa: E402
from snapmart.operators import changes, quality  # noqa: E402
from snapmart.operators.changes import ForeignKey  # noqa: E402
from snapmart.plans import catalog, reports  # noqa: E402
from snapmart_checks import REGISTRY  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = driver.queries(), driver.oracle_sql()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As if no table were small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


# These write tables and read them back; their last plan is a plain scan, and test_queries.py runs them.
WRITING = re.compile(r"load_|stream_|sync_(store|clashes|result|digests)|tables_reloaded|snapshots_appended")


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if not WRITING.match(n)))
def test_no_cross_join_and_no_python_rows(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "MapInPandas",
                "FlatMapGroups"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["top_entities", "by_category", "report_summary", "upsert_entities", "changed_rows",
                                  "cascade_delete", "replace_children", "sync_recent_changes", "assemble_feed",
                                  "fk_violations", "schedule_report"])
def test_results_without_broadcast(spark, no_broadcast, name):
    con = connection(SF_DIR)
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_filters_and_columns_reach_the_scan(spark):
    price = plan_of(QUERIES["expired_runs"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^]]*LessThan\(o_orderdate", price)
    entity = plan_of(QUERIES["entity_history"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(user_id,3\)", entity) and "props" not in entity
    behind = plan_of(QUERIES["scan_after_key"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThan\(event_id,", behind)


def test_one_shuffle_of_the_readings(spark, no_broadcast):
    """Latest rows, pairing and the join with the entities share one partitioning."""
    plan = plan_of(QUERIES["report_movers"](spark, SF_DIR))
    # below the cut to k rows; the names are looked up behind it
    below = plan.split("TakeOrderedAndProject", 2)[-1].split("FileScan parquet [p_partkey", 1)[0]
    assert below.count("Exchange hashpartitioning") == 2 and below.count("WindowGroupLimit") == 2


def test_hot_parent_is_split_by_adaptive_execution(spark, no_broadcast):
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        child = spark.range(0, 60_000, 1, 8).select(
            F.col("id").alias("child_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("ref"))
        parent = spark.range(1000).withColumnRenamed("id", "pk")
        gone = parent.where("pk % 2 = 0")
        left = changes.cascade_delete({"p": parent, "c": child}, [ForeignKey("c", "ref", "p", "pk")], "p", gone, "pk")["c"]
        assert left.count() == child.where("ref % 2 = 1").count()
        rows = left.collect()
        assert len(rows) == len({r["child_id"] for r in rows})
        assert "skew=true" in plan_of(left)
        assert quality.fk_violations(left, "ref", parent, "pk").count() == 0
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_other_column_names(spark):
    """The same queries on tables that call everything differently."""
    given = driver_tables.tables(spark, SF_DIR)
    roles = Roles()
    other = {f: f"x_{f}" for f in roles.__dataclass_fields__}
    # both tables call their text the same
    other["name"] = other["category_name"] = "title"

    def renamed(df):
        names = {v: other[k] for k, v in roles.__dict__.items()}
        return df.withColumnsRenamed({c: names[c] for c in df.columns})

    moved = Tables(*[renamed(getattr(given, t)) for t in ("entity", "category", "bridge", "snapshot", "rating")],
                   roles=roles.using(**other))
    for query in (catalog.top_entities, catalog.by_category, catalog.best_rated, reports.stats, reports.movers,
                  reports.report_top_now, reports.top_now, reports.report_top_categories, catalog.top_categories,
                  lambda t: catalog.by_price_range(t, 900, 910), lambda t: catalog.entity_history(t, 3)):
        want, got = query(given).collect(), query(moved).collect()
        assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, (tuple(r) for r in want)))


def test_doubled_pairs_and_ratings_are_counted_once(spark):
    t = driver_tables.tables(spark, SF_DIR)
    doubled = Tables(t.entity, t.category, t.bridge.unionByName(t.bridge), t.snapshot, t.rating.unionByName(t.rating))
    for figure in ("entities", "rated_entities"):
        assert reports.summary(doubled).first()[figure] == reports.summary(t).first()[figure]
        assert reports.stats(doubled).first()[figure] == reports.stats(t).first()[figure]
    want = {r["category_id"]: r["entities"] for r in catalog.by_category(t).collect()}
    assert {r["category_id"]: r["entities"] for r in catalog.by_category(doubled).collect()} == want


def test_category_figures_keep_no_set_of_pairs(spark, no_broadcast):
    """The bridge is sorted by entity; only the categories themselves are hashed."""
    t = driver_tables.tables(spark, SF_DIR)
    stored = t.bridge.localCheckpoint()
    plan = plan_of(catalog.by_category(Tables(t.entity, t.category, stored, t.snapshot, t.rating)))
    assert not re.search(r"HashAggregate\(keys=\[category_id#\d+L?, entity_id#", plan)
    assert not re.search(r"HashAggregate\(keys=\[entity_id#\d+L?, category_id#", plan)
    doubled = Tables(t.entity.unionByName(t.entity), t.category, stored.unionByName(stored), t.snapshot,
                     t.rating.unionByName(t.rating))
    assert sorted(catalog.by_category(doubled).collect()) == sorted(catalog.by_category(t).collect())


def test_lists_are_cut_before_names_are_looked_up(spark, no_broadcast):
    for name in ("report_top_now", "top_now", "report_movers"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        cut = re.search(r"\n( *)[^\n]*TakeOrderedAndProject\(limit=\d+[^\n]*", plan)
        assert cut and plan.index("p_name", 0) >= 0
        assert "p_name" not in plan[cut.start():].split("TakeOrderedAndProject", 1)[1].split("\n", 1)[0]


def test_sql_objects_on_demand(spark):
    t = driver_tables.tables(spark, SF_DIR)
    catalog.register_sql(t, "one_", ["by_category"])
    assert spark.catalog.tableExists("one_by_category") and not spark.catalog.tableExists("one_top_entities")
    with pytest.raises(ValueError):
        catalog.register_sql(t, "one_", ["nothing"])


def test_sql_functions_equal_the_plans(spark):
    t = driver_tables.tables(spark, SF_DIR)
    catalog.register_sql(t, "t_")
    pairs = [
        ("SELECT * FROM t_by_price_range(905, 915)", catalog.by_price_range(t, 905, 915)),
        ("SELECT * FROM t_by_min_rating(66.67)", catalog.by_min_rating(t, "66.67")),
        ("SELECT * FROM t_entity_history(3)", catalog.entity_history(t, 3)),
        ("SELECT * FROM t_top_entities", catalog.top_entities(t)),
        ("SELECT * FROM t_by_category", catalog.by_category(t)),
        ("SELECT * FROM t_best_rated", catalog.best_rated(t)),
    ]
    for text, df in pairs:
        found = spark.sql(text)
        assert sorted(map(str, found.select(df.columns).collect())) == sorted(map(str, df.collect()))
        assert found.count() > 0
    # a table function takes part in a larger query
    joined = spark.sql("SELECT c.category_name, count(*) AS n FROM t_by_price_range(905, 915) e "
                       "JOIN t_rating r ON r.entity_id = e.entity_id CROSS JOIN t_by_category c "
                       "WHERE c.entities = 0 GROUP BY c.category_name")
    assert joined.count() == 25


def test_report_parts_follow_from_the_views(spark):
    """The report recomputed from the two views."""
    t = driver_tables.tables(spark, SF_DIR)
    report = reports.daily_report(t, "1995-01-05")
    top = catalog.top_entities(t)
    totals = report.summary.first()
    assert totals["entities"] == top.count()
    assert totals["highest_peak"] <= top.agg(F.max("highest_peak")).first()[0]
    assert totals["last_update"] == top.agg(F.max("last_reading")).first()[0]
    counted = {r["category_name"]: r["entities"] for r in catalog.by_category(t).collect()}
    listed = report.top_categories.collect()
    assert [counted[r["category_name"]] for r in listed] == [r["entities"] for r in listed]
    assert listed[0]["entities"] == max(counted.values())


def test_empty_tables(spark):
    full = driver_tables.tables(spark, SF_DIR)
    t = Tables(*[getattr(full, n).limit(0) for n in ("entity", "category", "bridge", "snapshot", "rating")])
    row = reports.summary(t, "2024-01-01").first()
    assert (row["entities"], row["new_today"], row["current_total"], row["mean_rating"]) == (0, 0, None, None)
    for query in (catalog.top_entities, catalog.by_category, reports.movers, reports.top_now):
        assert query(t).count() == 0


def test_entity_without_readings_and_categories(spark):
    full = driver_tables.tables(spark, SF_DIR)
    t = Tables(full.entity, full.category, full.bridge.where("entity_id <> 5"), full.snapshot.where("entity_id <> 5"),
               full.rating.where("entity_id <> 5"))
    row = catalog.top_entities(t).where("entity_id = 5").first()
    assert (row["highest_peak"], row["last_reading"], row["categories"], row["label"]) == (None,) * 4


def test_category_order_by_collation(spark):
    t = Tables(category=spark.createDataFrame([(1, "Zeta"), (2, "alfa"), (3, "Élite"), (4, "beta")],
                                              "category_id long, category_name string"),
               bridge=spark.createDataFrame([(1, i) for i in range(1, 5)], "entity_id long, category_id long"))
    assert catalog.category_lists(t).first()["categories"] == "Zeta, alfa, beta, Élite"
    assert catalog.category_lists(t, "es_CI_AI_RTRIM").first()["categories"] == "alfa, beta, Élite, Zeta"
