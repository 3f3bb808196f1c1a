"""The driver's tables in the roles of the data model.

One SQL text per role, the same for both engines: Spark fills the braces with
DataFrames, the SQL check with table names. All but the two grouped ones are
row by row, so that a role costs no more than reading its tables.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession

from snapmart.roles import Tables
from snapmart.session import shuffle_partitions

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

SQL = {
    # one row per part; lines give the two times
    "entity": """
        SELECT p.p_partkey AS entity_id, p.p_partkey * 10 + 7 AS external_id, p.p_name AS name,
               CASE WHEN p.p_size = 29 THEN NULL ELSE concat(p.p_name, ' by ', p.p_brand) END AS description,
               CAST(p.p_retailprice AS DECIMAL(10,2)) AS price,
               CASE WHEN p.p_size = 23 THEN NULL ELSE DATE '2000-01-01' + p.p_size END AS released,
               CASE WHEN p.p_size IN (10, 20, 30, 40, 50) THEN NULL ELSE p.p_brand END AS maker,
               p.p_type AS publisher, t.created_at, t.updated_at
        FROM {part} p
        LEFT JOIN (SELECT l_partkey, min(l_shipdate) AS created_at, max(l_shipdate) AS updated_at
                   FROM {lineitem} GROUP BY l_partkey) t ON t.l_partkey = p.p_partkey""",
    # suppliers; nations are categories without entities
    "category": """
        SELECT s_suppkey AS category_id, s_name AS category_name FROM {supplier}
        UNION ALL
        SELECT CAST(-1 - n_nationkey AS BIGINT) AS category_id, n_name AS category_name FROM {nation}""",
    "bridge": """
        SELECT DISTINCT l_partkey AS entity_id, l_suppkey AS category_id FROM {lineitem}""",
    # one reading per event
    "snapshot": """
        SELECT event_id AS snapshot_id, user_id AS entity_id,
               CAST(round(value * 100) AS BIGINT) AS current_count,
               CAST(round(value * 100) AS BIGINT)
                 + CASE WHEN event_type = 'view' THEN 0 ELSE 250 END AS peak_count,
               event_id * 3 AS total_ratings, ts AS recorded_at
        FROM {events}""",
    # lines are votes; which are against depends on the size; parts of size 13 are not rated
    "rating": """
        SELECT entity_id + 1 AS rating_id, entity_id, positive, negative,
               CAST(CAST((positive * 20000 + positive + negative) {div} (2 * (positive + negative))
                         AS DECIMAL(10,0)) / 100 AS DECIMAL(5,2)) AS positive_pct,
               CASE WHEN positive + negative < 2 THEN NULL
                    WHEN negative = 0 THEN 'Very Positive'
                    WHEN positive > negative THEN 'Mostly Positive'
                    WHEN positive = negative THEN 'Mixed'
                    WHEN positive > 0 THEN 'Mostly Negative'
                    ELSE 'Very Negative' END AS label
        FROM (SELECT entity_id, CAST(sum(CASE WHEN against THEN 0 ELSE 1 END) AS BIGINT) AS positive,
                     CAST(sum(CASE WHEN against THEN 1 ELSE 0 END) AS BIGINT) AS negative
              FROM (SELECT l_partkey AS entity_id, CASE WHEN p_size < 3 THEN l_discount <= 0.08 WHEN p_size < 10 THEN l_returnflag <> 'N'
                                        WHEN p_size < 30 THEN l_returnflag = 'R'
                                        ELSE l_returnflag = 'R' AND l_discount > 0.05 END AS against
                    FROM {lineitem} JOIN {part} ON p_partkey = l_partkey WHERE p_size <> 13) w
              GROUP BY entity_id) v""",
    # discounted lines are votes against; of the small parts only, and of those of size 13
    "new_rating": """
        SELECT entity_id, positive, negative,
               CAST(CAST((positive * 20000 + positive + negative) {div} (2 * (positive + negative))
                         AS DECIMAL(10,0)) / 100 AS DECIMAL(5,2)) AS positive_pct,
               CASE WHEN positive > negative THEN 'Positive' ELSE 'Negative' END AS label
        FROM (SELECT l_partkey AS entity_id,
                     CAST(sum(CASE WHEN l_discount <= 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS positive,
                     CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS negative
              FROM {lineitem} JOIN {part} ON p_partkey = l_partkey WHERE p_size < 20 GROUP BY l_partkey) v""",
    # two images of the entities: size 7 is added, size 11 removed, others edited
    "before": """
        SELECT p_partkey AS entity_id, p_name AS name, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
               CASE WHEN p_size = 23 THEN NULL ELSE DATE '2000-01-01' + p_size END AS released,
               CASE WHEN p_size IN (10, 20, 30, 40, 50) THEN NULL ELSE p_brand END AS maker,
               p_type AS publisher
        FROM {part} WHERE p_size <> 7""",
    "after": """
        SELECT p_partkey AS entity_id, CASE WHEN p_size = 17 THEN upper(p_name) ELSE p_name END AS name,
               CAST(CASE WHEN p_size IN (5, 15, 25) THEN p_retailprice + 1 ELSE p_retailprice END
                    AS DECIMAL(10,2)) AS price,
               CASE WHEN p_size = 23 THEN NULL ELSE DATE '2000-01-01' + p_size END AS released,
               CASE WHEN p_size IN (10, 20) THEN '' WHEN p_size IN (30, 40, 50) THEN NULL
                    ELSE p_brand END AS maker,
               CASE WHEN p_size = 19 THEN 'OTHER' ELSE p_type END AS publisher
        FROM {part} WHERE p_size <> 11""",
    # the readings after errors were corrected and sign-ups withdrawn
    "corrected": """
        SELECT event_id AS snapshot_id, user_id AS entity_id,
               CAST(round(value * 100) AS BIGINT) + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS current_count,
               CAST(round(value * 100) AS BIGINT)
                 + CASE WHEN event_type = 'view' THEN 0 ELSE 250 END AS peak_count,
               event_id * 3 AS total_ratings, ts AS recorded_at
        FROM {events} WHERE event_type <> 'signup'""",
    # an older copy: the newest fifth of the ids is missing, some prices are stale
    "target_entity": """
        SELECT p_partkey AS entity_id, p_partkey * 10 + 7 AS external_id, p_name AS name,
               CAST(CASE WHEN p_size = 6 THEN p_retailprice - 1 ELSE p_retailprice END AS DECIMAL(10,2)) AS price
        FROM {part} WHERE p_partkey < (SELECT max(p_partkey) FROM {part}) * 4 / 5""",
    "target_snapshot": """
        SELECT event_id AS snapshot_id, user_id AS entity_id,
               CAST(round(value * 100) AS BIGINT) AS current_count,
               CAST(round(value * 100) AS BIGINT)
                 + CASE WHEN event_type = 'view' THEN 0 ELSE 250 END AS peak_count,
               event_id * 3 AS total_ratings, ts AS recorded_at
        FROM {events} WHERE ts < TIMESTAMP '2024-01-25 00:00:00'""",
    # orders as audit rows
    "audit": """
        SELECT o_orderkey AS audit_id, 'shop' AS database_name,
               CASE WHEN o_orderpriority LIKE '1%' THEN 'rating' WHEN o_orderpriority LIKE '2%' THEN 'snapshot'
                    ELSE 'entity' END AS table_name,
               CASE o_orderstatus WHEN 'F' THEN 'INSERT' WHEN 'O' THEN 'UPDATE' ELSE 'DELETE' END AS operation,
               o_orderdate AS logged_at, concat('user_', CAST(o_custkey AS VARCHAR(20))) AS user_name,
               CASE WHEN o_orderstatus <> 'O' THEN NULL WHEN o_totalprice > 200000 THEN '["name","price"]'
                    ELSE '["price"]' END AS changed_fields
        FROM {orders}""",
    # orders as runs, ended by their last line
    "run": """
        SELECT o.o_orderkey AS run_id,
               CASE WHEN o.o_orderpriority = '5-LOW' THEN 'archive' ELSE 'shop' END AS database_name,
               CASE o.o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'I' ELSE 'X' END AS kind,
               o.o_orderdate AS started, m.finished, o.o_totalprice AS bytes
        FROM {orders} o
        JOIN (SELECT l_orderkey, max(l_shipdate) AS finished FROM {lineitem} GROUP BY l_orderkey) m
          ON m.l_orderkey = o.o_orderkey""",
    "run_file": """
        SELECT o_orderkey AS run_id, concat('/runs/', o_orderpriority) AS file FROM {orders}""",
    # suppliers and customers as jobs, nations as schedules
    "job": """
        SELECT s_suppkey AS job_id, s_name AS job_name, s_acctbal > 0 AS enabled FROM {supplier}
        UNION ALL
        SELECT -1 - c_custkey AS job_id, c_name AS job_name, c_acctbal > 0 AS enabled FROM {customer}""",
    "job_schedule": """
        SELECT s_suppkey AS job_id, s_nationkey AS schedule_id FROM {supplier}
        UNION ALL
        SELECT -1 - c_custkey AS job_id, c_nationkey AS schedule_id FROM {customer}""",
    "schedule": """
        SELECT n_nationkey AS schedule_id, n_name AS schedule_name,
               CASE WHEN n_regionkey IN (0, 3) THEN 4 WHEN n_regionkey IN (1, 4) THEN 8 ELSE 12 END AS freq_type,
               CASE n_regionkey WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 8 ELSE 2 END AS subday_type,
               n_regionkey * 5 AS subday_every, n_nationkey * 10000 + n_regionkey * 1000 AS start_hhmmss,
               n_regionkey <> 4 AS schedule_enabled
        FROM {nation}""",
}


# Declared like all schemas, so that opening a table starts no job.
COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def dealt(table: DataFrame, key: str) -> DataFrame:
    """A table of few bytes but many rows, which one or two tasks would read, dealt over all of them."""
    return table.repartition(shuffle_partitions(table.sparkSession), key)


def role(spark: SparkSession, sf_dir: str, name: str, deal: Mapping[str, str] = MappingProxyType({})) -> DataFrame:
    """One role as a DataFrame; ``deal`` names tables to be ``dealt``, each with its key."""
    text = SQL[name].replace("TIMESTAMP '", "TIMESTAMP_NTZ '").replace("{div}", "div")
    used = set(re.findall(r"\{(\w+)\}", text))
    read = {t: driver_table(spark, sf_dir, t) for t in used}
    return spark.sql(text, **{t: dealt(df, deal[t]) if t in deal else df for t, df in read.items()})


def role_sql(name: str) -> str:
    """The same role for the SQL check, over tables of the driver's names."""
    return SQL[name].format(div="//", **{t: t for t in DRIVER_TABLES})


def tables(spark: SparkSession, sf_dir: str, *names: str) -> Tables:
    """The named roles, or all five."""
    wanted = names or ("entity", "category", "bridge", "snapshot", "rating")
    return Tables(**{n: role(spark, sf_dir, n) for n in wanted})
