"""The 17-column issue table.

Real exports arrive as CSV / JSON lines / Parquet (see ``files``). For tests and the
registered queries the table is derived from the TPC-H-style tables of a data folder:
an order is an issue, its first ship date after the order date is the resolution date,
line counts stand in for comment/vote/watch counts. The same derivation is written as
SQL (``ISSUES_SQL``) so DuckDB can check every query on identical rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_if_small, cleanup_at_exit, path_exists, scratch_path, shuffles_for
from .tables import table

# Column order and types of the issue export.
ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("updated", T.TimestampNTZType()),
        T.StructField("issue_type", T.StringType()),
        T.StructField("reporter", T.StringType()),
        T.StructField("created", T.TimestampNTZType()),
        T.StructField("resolutiondate", T.TimestampNTZType()),
        T.StructField("vote_count", T.LongType()),
        T.StructField("project", T.StringType()),
        T.StructField("assignee", T.StringType()),
        T.StructField("comment_count", T.LongType()),
        T.StructField("key", T.LongType()),
        T.StructField("description_length", T.DoubleType()),
        T.StructField("summary_length", T.LongType()),
        T.StructField("watch_count", T.LongType()),
        T.StructField("resolution", T.StringType()),
        T.StructField("days_in_current_status", T.DoubleType()),
    ]
)
ISSUE_COLUMNS = [f.name for f in ISSUE_SCHEMA.fields]

ISSUE_SQL_TABLES = ["orders", "lineitem", "customer", "nation"]

# The derivation as SQL, runnable unchanged by Spark and DuckDB.
ISSUES_SQL = """
WITH li AS (
  SELECT l_orderkey AS k, count(*) AS n_lines,
         count(DISTINCT l_suppkey) AS n_supp,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_ret
  FROM lineitem GROUP BY l_orderkey),
rs AS (
  SELECT o_orderkey AS k, min(l_shipdate) AS resolutiondate
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE l_shipdate > o_orderdate GROUP BY o_orderkey)
SELECT CASE WHEN rs.resolutiondate IS NULL AND o_orderstatus = 'O' THEN 'Open'
            WHEN rs.resolutiondate IS NULL AND o_orderstatus = 'P' THEN 'PatchAvailable'
            WHEN rs.resolutiondate IS NULL THEN 'Reopened'
            WHEN o_orderkey % 3 = 0 THEN 'Closed' ELSE 'Resolved' END AS status,
       o_orderpriority AS priority,
       coalesce(rs.resolutiondate, o_orderdate) AS updated,
       c_mktsegment AS issue_type,
       n_name AS reporter,
       o_orderdate AS created,
       rs.resolutiondate AS resolutiondate,
       CAST(coalesce(li.n_ret, 0) AS BIGINT) AS vote_count,
       'DEMO' AS project,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL
            WHEN o_orderkey % 4 = 1 THEN n_name
            ELSE concat('NATION_', CAST((o_orderkey * 7) % 25 AS VARCHAR(8))) END AS assignee,
       CAST(coalesce(li.n_lines, 0) AS BIGINT) AS comment_count,
       o_orderkey AS key,
       CASE WHEN o_orderkey % 20 = 7 THEN NULL
            ELSE CAST(floor(o_totalprice / 100) AS DOUBLE) END AS description_length,
       CAST(15 + (o_orderkey * 31) % 120 AS BIGINT) AS summary_length,
       CAST(coalesce(li.n_supp, 0) AS BIGINT) AS watch_count,
       CASE WHEN rs.resolutiondate IS NULL THEN NULL
            WHEN o_orderstatus = 'P' THEN 'Duplicate'
            WHEN o_orderkey % 11 = 0 THEN 'Invalid' ELSE 'Fixed' END AS resolution,
       CAST(o_orderkey % 1000 AS DOUBLE) AS days_in_current_status
FROM orders
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN li ON li.k = o_orderkey
LEFT JOIN rs ON rs.k = o_orderkey
"""

# Sub-day durations: the gap between a user's consecutive events.
EVENT_GAPS_SQL = """
SELECT event_id AS key, user_id, event_type, ts AS created,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS resolutiondate
FROM events
"""


def issues_from_tables(spark: SparkSession, data_dir: str) -> DataFrame:
    """Derive the issue table with the DataFrame API (same rows as ``ISSUES_SQL``).

    Plan: lineitem is joined once to the order dates and reduced per order (partial
    aggregation before the shuffle); orders keep their one row per key through a left
    join to that per-order table; nation (a 25-row dimension) is broadcast after its row
    count is checked.
    """
    orders = table(spark, data_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    lineitem = table(spark, data_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate")
    customer = table(spark, data_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, data_dir, "nation").select("n_nationkey", "n_name")

    per_order = (
        lineitem.join(orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.count_distinct("l_suppkey").alias("n_supp"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
            F.min(F.when(F.col("l_shipdate") > F.col("o_orderdate"), F.col("l_shipdate"))).alias("rs_date"),
        )
    )
    k = F.col("o_orderkey")
    rs = F.col("rs_date")
    df = (
        orders.join(customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(broadcast_if_small(nation), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(per_order, F.col("l_orderkey") == k, "left")
    )
    return df.select(
        F.when(rs.isNull() & (F.col("o_orderstatus") == "O"), "Open")
        .when(rs.isNull() & (F.col("o_orderstatus") == "P"), "PatchAvailable")
        .when(rs.isNull(), "Reopened")
        .when(k % 3 == 0, "Closed")
        .otherwise("Resolved")
        .alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.coalesce(rs, F.col("o_orderdate")).alias("updated"),
        F.col("c_mktsegment").alias("issue_type"),
        F.col("n_name").alias("reporter"),
        F.col("o_orderdate").alias("created"),
        rs.alias("resolutiondate"),
        F.coalesce(F.col("n_ret"), F.lit(0)).cast("bigint").alias("vote_count"),
        F.lit("DEMO").alias("project"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 1, F.col("n_name"))
        .otherwise(F.concat(F.lit("NATION_"), ((k * 7) % 25).cast("string")))
        .alias("assignee"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("bigint").alias("comment_count"),
        k.alias("key"),
        F.when(k % 20 == 7, F.lit(None).cast("double"))
        .otherwise(F.floor(F.col("o_totalprice") / 100).cast("double"))
        .alias("description_length"),
        (F.lit(15) + (k * 31) % 120).cast("bigint").alias("summary_length"),
        F.coalesce(F.col("n_supp"), F.lit(0)).cast("bigint").alias("watch_count"),
        F.when(rs.isNull(), F.lit(None).cast("string"))
        .when(F.col("o_orderstatus") == "P", "Duplicate")
        .when(k % 11 == 0, "Invalid")
        .otherwise("Fixed")
        .alias("resolution"),
        (k % 1000).cast("double").alias("days_in_current_status"),
    )


def fingerprint(spark: SparkSession, data_dir: str, names: list[str]) -> str:
    """Hash of the files of the tables ``names``: paths, sizes and times from their file system,
    whichever it is."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    h = hashlib.sha1()
    for n in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{data_dir.rstrip('/')}/{n}.parquet")
        for f in path.getFileSystem(conf).listStatus(path):
            h.update(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}\n".encode())
    return h.hexdigest()[:16]


def issues(spark: SparkSession, data_dir: str, materialize: bool = True) -> DataFrame:
    """The issue table for ``data_dir``, written once as Parquet under the shared checkpoint
    folder and read back, so later queries start from a short lineage (and survive lost
    executors) instead of re-running the four-way join."""
    if not materialize:
        return issues_from_tables(spark, data_dir)
    target = scratch_path(spark, f"issues-{fingerprint(spark, data_dir, ISSUE_SQL_TABLES)}", unique=False)
    if not path_exists(spark, f"{target}/_SUCCESS"):
        with shuffles_for(spark, table(spark, data_dir, "lineitem").count()):  # the count of the files' footers
            issues_from_tables(spark, data_dir).write.mode("overwrite").parquet(target)
        cleanup_at_exit(spark, target)
    return spark.read.schema(ISSUE_SCHEMA).parquet(target)


def event_gaps(spark: SparkSession, data_dir: str) -> DataFrame:
    """Events as issues with sub-day durations: created = event time, resolutiondate = the
    same user's next event (null for the last one). The successor is found by ranking rows
    in (user_id, ts, event_id) order over range partitions and joining rank r to r+1, so a
    user holding a third of all events is still spread over many tasks."""
    from ..operators.ordering import rank_rows

    ev = table(spark, data_dir, "events").select(
        F.col("event_id").alias("key"), "user_id", "event_type", F.col("ts").alias("created")
    )
    ranked = rank_rows(ev, ["created", "key"], by=["user_id"], rank_col="_r")
    nxt = ranked.select(
        F.col("user_id").alias("_u"), (F.col("_r") - 1).alias("_r_prev"), F.col("created").alias("resolutiondate")
    )
    return ranked.join(
        nxt, (F.col("user_id").eqNullSafe(F.col("_u"))) & (F.col("_r") == F.col("_r_prev")), "left"
    ).select("key", "user_id", "event_type", "created", "resolutiondate")
