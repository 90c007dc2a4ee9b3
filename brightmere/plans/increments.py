"""High-water marks, change feeds, re-ingest and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from brightmere.operators import increment, joins, retention
from brightmere.operators.load import by_partition
from brightmere.plans.registry import query
from brightmere.plans.scans import _order_versions, _orders_by_month
from brightmere.session import scratch, scratch_name
from brightmere.sources import versions


def _copies(spark, t):
    """Two copies: one when the source ended in 1997, one later; a third finds nothing."""
    target, marks = scratch(spark, "copy"), scratch(spark, "marks")
    runs = []
    for source in (t.orders.where(F.year("o_orderdate") <= 1997), t.orders, t.orders):
        runs.append(increment.hwm_copy(source, target, "o_orderdate", marks, "orders"))
    return target, runs


@query("hwm_copy", "SELECT o_orderkey, o_orderdate FROM orders")
def hwm_copy(spark, t):
    target, _ = _copies(spark, t)
    return increment.read_increments(spark, target).select("o_orderkey", "o_orderdate")


@query(
    "hwm_new_columns",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) > 1997 THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def hwm_new_columns(spark, t):
    """The second copy has a column more."""
    target, marks = scratch(spark, "copy"), scratch(spark, "marks")
    narrow = t.orders.where(F.year("o_orderdate") <= 1997).select("o_orderkey", "o_orderdate")
    wide = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority")
    for source in (narrow, wide):
        increment.hwm_copy(source, target, "o_orderdate", marks, "orders")
    return increment.read_increments(spark, target).select("o_orderkey", "o_orderpriority")


@query(
    "hwm_marks",
    """SELECT 0 AS run, TIMESTAMP '1900-01-01' AS old, max(o_orderdate) AS new FROM orders WHERE year(o_orderdate) <= 1997
       UNION ALL SELECT 1, (SELECT max(o_orderdate) FROM orders WHERE year(o_orderdate) <= 1997), max(o_orderdate) FROM orders
       UNION ALL SELECT 2, max(o_orderdate), max(o_orderdate) FROM orders""",
)
def hwm_marks(spark, t):
    _, runs = _copies(spark, t)
    rows = [(i, old, new) for i, (old, new) in enumerate(runs)]
    return spark.createDataFrame(rows, "run INT, old TIMESTAMP_NTZ, new TIMESTAMP_NTZ")


@query(
    "max_version",
    "SELECT 2::BIGINT AS newest, count(*) AS rows FROM orders WHERE year(o_orderdate) >= 1999",
)
def max_version(spark, t):
    root = _order_versions(spark, t)
    newest = versions.current_version(spark, root)
    return versions.changes_since(spark, root, newest).agg(
        F.max(versions.VERSION).alias("newest"), F.count(F.lit(1)).alias("rows")
    )


def _context(t):
    return t.customer.where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("context_segment")
    )


@query(
    "enrich_changes",
    """SELECT o_orderkey, o_custkey, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS context_segment
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) >= 1997""",
)
def enrich_changes(spark, t):
    changes = versions.changes_since(spark, _order_versions(spark, t), 1)
    return joins.enrich(changes.select("o_orderkey", "o_custkey"), _context(t), "o_custkey").select(
        "o_orderkey", "o_custkey", "context_segment"
    )


@query(
    "cdf_increment",
    """SELECT CASE WHEN year(o_orderdate) <= 1998 THEN 0 ELSE 1 END AS run, o_orderkey,
              CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS context_segment
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def cdf_increment(spark, t):
    """Three increments: two commits, one commit, nothing."""
    root, marks = scratch(spark, "feed"), scratch(spark, "markers")
    year = F.year("o_orderdate")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    batches = [[year <= 1996, year.between(1997, 1998)], [year >= 1999], []]
    found = []
    for run, commits in enumerate(batches):
        for batch in commits:
            versions.commit(t.orders.where(batch).select(*columns), root)
        rows, _, upto = increment.cdf_increment(spark, root, marks, "orders", _context(t), "o_custkey")
        stored = scratch(spark, "increment")
        rows.select(F.lit(run).alias("run"), "o_orderkey", "context_segment").write.parquet(stored)
        increment.confirm(spark, marks, "orders", upto)
        found.append(stored)
    return spark.read.schema("run INT, o_orderkey BIGINT, context_segment STRING").parquet(*found)


@query(
    "reingest_plan",
    """SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
              CASE WHEN year(o_orderdate) >= 1999 THEN 'new' ELSE 'changed' END AS reason
       FROM orders WHERE year(o_orderdate) >= 1997 GROUP BY ALL""",
)
def reingest_plan(spark, t):
    """Order months: up to 1996 copied two seconds after the change, 1997 within the
    tolerance of one, 1998 before it, the later ones never."""
    changed = t.orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.max("o_orderdate").alias("changed")
    )
    lag = (
        F.when(F.col("year") <= 1996, F.make_dt_interval(secs=F.lit(2)))
        .when(F.col("year") == 1997, F.make_dt_interval(secs=F.lit(1)))
        .otherwise(F.make_dt_interval(days=F.lit(-1)))
    )
    copied = F.when(F.col("year") <= 1998, (F.col("changed") + lag).cast("string")).otherwise("")
    config = changed.select(
        "year",
        "month",
        F.col("changed").cast("string").alias("lastUpdatedSourceSystem"),
        copied.alias("lastUpdatedDatalake"),
    )
    return increment.reingest_plan(config).select("year", "month", "reason")


CUTOFF = dt.datetime(1997, 5, 15)


@query(
    "retention_rows",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS o_orderdate,
              year(o_orderdate)::INTEGER AS year
       FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderdate >= TIMESTAMP '1997-05-15'""",
)
def retention_rows(spark, t):
    """Rows before the cutoff go; urgent orders have no date and stay."""
    table = scratch_name("orders")
    undated = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))
    dated = t.orders.select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), undated.alias("o_orderdate")
    )
    by_partition(dated, "year", "month").write.partitionBy("year", "month").option("path", scratch(spark, table)).saveAsTable(table)
    retention.retain_rows(spark, table, "o_orderdate", CUTOFF, ["year", "month"])
    return spark.table(table).select("o_orderkey", "o_orderdate", "year")


@query(
    "retention_partitions",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS rows FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-05-15' GROUP BY ALL""",
)
def retention_partitions(spark, t):
    """What the catalog still lists after a retention run."""
    table = _orders_by_month(spark, t)
    retention.retain_rows(spark, table, "o_orderdate", CUTOFF, ["year", "month"])
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.regexp_extract("partition", r"year=(\d+)", 1).alias("year"),
        F.lpad(F.regexp_extract("partition", r"month=(\d+)", 1), 2, "0").alias("m"),
    )
    months = listed.select(F.concat_ws("-", "year", "m").alias("month"))
    rows = spark.table(table).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return months.join(rows, "month", "left")


@query(
    "retention_versioned",
    """SELECT 'rows' AS what, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1997-05-15'
       UNION ALL SELECT 'oldest version', 2""",
)
def retention_versioned(spark, t):
    """A versioned table after retention: its rows, and the oldest version that is left."""
    root = scratch(spark, "versions")
    for batch in (F.year("o_orderdate") <= 1996, F.year("o_orderdate") > 1996):
        versions.commit(t.orders.where(batch).select("o_orderkey", "o_orderdate"), root, zones=["o_orderdate"])
    retention.retain_version(spark, root, "o_orderdate", CUTOFF)
    rows = versions.read_version(spark, root).agg(F.count(F.lit(1)).alias("n"))
    oldest = versions.history(spark, root).where("operation = 'vacuum'").select(F.col("version").alias("n"))
    return rows.select(F.lit("rows").alias("what"), "n").unionByName(
        oldest.select(F.lit("oldest version").alias("what"), "n")
    )


@query(
    "retention_plan",
    """SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
              CASE WHEN last_day(max(o_orderdate)) < DATE '1997-05-15' THEN 'drop' ELSE 'keep' END AS action,
              year(o_orderdate) <= 1996 AS drop_year
       FROM orders GROUP BY 1, 2, 4""",
)
def retention_plan(spark, t):
    months = t.orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).distinct()
    return retention.retention_plan(months, CUTOFF.date())
