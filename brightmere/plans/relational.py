"""Projections, filters, aggregates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightmere.functions import scalars
from brightmere.functions.plugins import run_plugin
from brightmere.functions.sqlfuncs import register_sql_functions
from brightmere.operators import aggregates, features, increment, topk
from brightmere.plans.registry import query
from brightmere.session import scratch, scratch_name


def money(name: str):
    """A two-digit amount as a decimal, so that sums do not depend on their order."""
    return F.col(name).cast("decimal(18,2)")


def total(name: str):
    return F.sum(money(name)).cast("double")


@query(
    "project_rename",
    "SELECT p_partkey AS part, p_name AS name, p_retailprice AS price FROM part",
)
def project_rename(spark, t):
    return t.part.select(
        F.col("p_partkey").alias("part"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")
    )


@query("add_literal", "SELECT s_suppkey, s_name, 10 AS amount FROM supplier")
def add_literal(spark, t):
    rows = t.supplier.select("s_suppkey", "s_name")
    return run_plugin(spark, "add_literal", rows, {"name": "amount", "value": 10})


@query("double_price", "SELECT p_partkey, p_name, p_retailprice * 2 AS price FROM part")
def double_price(spark, t):
    return t.part.select("p_partkey", "p_name", (F.col("p_retailprice") * 2).alias("price"))


@query(
    "filter_load",
    "SELECT o_orderkey, o_custkey FROM orders WHERE strftime(o_orderdate, '%Y%m') = '199705'",
)
def filter_load(spark, t):
    """Rows of one load, the load being the order month; a range, which the scan can use."""
    return t.orders.where(_from_to("o_orderdate", "1997-05-01", "1997-06-01")).select("o_orderkey", "o_custkey")


def _from_to(col, low, high):
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (low, high))
    return (F.col(col) >= low) & (F.col(col) < high)


@query(
    "filter_isin",
    "SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#2', 'Brand#17')",
)
def filter_isin(spark, t):
    config = {"key_col": "p_brand", "filter_criteria": ["Brand#2", "Brand#17"]}
    return run_plugin(spark, "data_filter", t.part, config).select("p_partkey", "p_brand")


@query(
    "dropna_subset",
    "SELECT event_id, user_id, value FROM events WHERE event_type <> 'error' AND value >= 1",
)
def dropna_subset(spark, t):
    """Values below 1 and the type error count as missing."""
    holes = t.events.select(
        "event_id",
        "user_id",
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("kind"),
    )
    return holes.dropna(subset=["value", "kind"]).drop("kind")


@query(
    "drop_sentinels",
    """SELECT p_partkey, p_size, p_brand FROM part
       WHERE p_size NOT IN (1, 2) AND p_brand NOT IN ('Brand#1', 'Brand#2')""",
)
def drop_sentinels(spark, t):
    rows = t.part.select("p_partkey", "p_size", "p_brand")
    return features.without(features.without(rows, ["p_size"], [1, 2]), ["p_brand"], ["Brand#1", "Brand#2"])


@query("find_sentinels", "SELECT p_partkey, p_size FROM part WHERE p_size IN (1, 2)")
def find_sentinels(spark, t):
    return t.part.where(F.col("p_size").isin(1, 2)).select("p_partkey", "p_size")


@query(
    "filter_month_version",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE date_trunc('month', o_orderdate) = (SELECT date_trunc('month', min(o_orderdate)) + INTERVAL 11 MONTH FROM orders)""",
)
def filter_month_version(spark, t):
    """Orders by month of issue; version 11 of data that begins in January is December."""
    issued = t.orders.select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("issue_d"))
    return increment.filter_month_version(issued, "issue_d", 11).drop("issue_d")


@query(
    "watermark_range",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate > TIMESTAMP '1998-03-01' AND o_orderdate <= TIMESTAMP '1998-06-01'""",
)
def watermark_range(spark, t):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1998-03-01", "1998-06-01"))
    return increment.hwm_range(t.orders, "o_orderdate", low, high).select("o_orderkey", "o_orderdate")


@query(
    "first_period",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT min(o_orderdate) FROM orders)",
)
def first_period(spark, t):
    view = scratch_name("orders")
    t.orders.createOrReplaceTempView(view)
    return spark.sql(
        f"SELECT o_orderkey, o_custkey FROM {view} WHERE o_orderdate = (SELECT min(o_orderdate) FROM {view})"
    )


@query(
    "lookup_customer",
    """SELECT c_custkey AS "CustomerID", c_name AS "Name", c_mktsegment AS "Segment"
       FROM customer WHERE c_custkey = 42""",
)
def lookup_customer(spark, t):
    view = scratch_name("customers")
    t.customer.select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Segment"),
    ).createOrReplaceTempView(view)
    register_sql_functions(spark, customers=view)
    return spark.sql("SELECT * FROM customer_information(42)")


@query("column_view", "SELECT o_orderkey, o_totalprice FROM orders")
def column_view(spark, t):
    source, view = scratch_name("orders"), scratch_name("orders_public")
    t.orders.createOrReplaceTempView(source)
    spark.sql(f"CREATE TEMPORARY VIEW {view} AS SELECT o_orderkey, o_totalprice FROM {source}")
    return spark.table(view)


@query("drop_columns", "SELECT * EXCLUDE (c_name, c_mktsegment) FROM customer")
def drop_columns(spark, t):
    return t.customer.drop("c_name", "c_mktsegment")


@query("columns_front", "SELECT p_size, p_brand, * EXCLUDE (p_size, p_brand) FROM part")
def columns_front(spark, t):
    return scalars.columns_front(t.part, ["p_size", "p_brand"])


@query(
    "filter_year",
    "SELECT o_orderkey, o_custkey, 1996 AS year FROM orders WHERE year(o_orderdate) = 1996",
)
def filter_year(spark, t):
    dated = t.orders.where(_from_to("o_orderdate", "1996-01-01", "1997-01-01"))
    return dated.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))


@query(
    "text_contains",
    "SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'license') AND NOT contains(lower(text), 'http')",
)
def text_contains(spark, t):
    wanted = aggregates.text_contains(F.col("text"), "License")
    unwanted = aggregates.text_contains(F.col("text"), "HTTP")
    return t.documents.where(wanted & ~unwanted).select("doc_id", "lang")


@query(
    "column_if_exists",
    """SELECT c_custkey, c_name AS tag_absent,
              CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE c_mktsegment END AS tag_present
       FROM customer""",
)
def column_if_exists(spark, t):
    """One preferred column that does not exist, and one that is empty for a segment."""
    rows = t.customer.withColumn(
        "namespace", F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    )
    return rows.select(
        "c_custkey",
        scalars.first_present(rows, "no_such_column", "c_name").alias("tag_absent"),
        scalars.first_present(rows, "namespace", "c_name").alias("tag_present"),
    )


@query("count_rows", "SELECT count(*) AS total FROM lineitem")
def count_rows(spark, t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("total"))


@query("count_by_key", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def count_by_key(spark, t):
    return t.events.groupBy("event_type").count()


@query("distinct_keys", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_keys(spark, t):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query(
    "dedupe_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def dedupe_key(spark, t):
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return topk.first_per_key(t.orders, ["o_custkey"], order).select("o_custkey", "o_orderkey", "o_totalprice")


@query("distinct_values", "SELECT DISTINCT p_type FROM part")
def distinct_values(spark, t):
    return t.part.select("p_type").distinct()


@query(
    "dup_groups",
    """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def dup_groups(spark, t):
    return aggregates.dup_groups(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("high_water_mark", "SELECT max(o_orderdate) AS mark FROM orders")
def high_water_mark(spark, t):
    return t.orders.agg(F.max("o_orderdate").alias("mark"))


@query(
    "null_counts",
    """UNPIVOT (SELECT count_if(nullif(event_type, 'error') IS NULL)::BIGINT AS event_type,
                       count_if(CASE WHEN value >= 1 THEN value END IS NULL)::BIGINT AS value,
                       count_if(user_id IS NULL)::BIGINT AS user_id FROM events)
       ON COLUMNS(*) INTO NAME "column" VALUE nulls""",
)
def null_counts(spark, t):
    return aggregates.null_counts(_with_holes(t))


@query(
    "nonnull_counts",
    """UNPIVOT (SELECT count(nullif(event_type, 'error')) AS event_type,
                       count(CASE WHEN value >= 1 THEN value END) AS value,
                       count(user_id) AS user_id FROM events)
       ON COLUMNS(*) INTO NAME "column" VALUE "values" """,
)
def nonnull_counts(spark, t):
    return aggregates.nonnull_counts(_with_holes(t))


def _with_holes(t):
    return t.events.select(
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
        "user_id",
    )


@query(
    "histogram",
    """WITH edges AS (SELECT min(l_quantity) AS low, max(l_quantity) AS high, count(*) AS n FROM lineitem)
       SELECT least(floor((l_quantity - low) / ((high - low) / 7)) + 1, 7)::BIGINT AS bin,
              round(any_value(low + (least(floor((l_quantity - low) / ((high - low) / 7)), 6)) * (high - low) / 7), 6) AS low,
              count(*) AS count, round(count(*) / any_value(n), 9) AS share
       FROM lineitem, edges GROUP BY ALL""",
)
def histogram(spark, t):
    bins = aggregates.histogram(t.lineitem, "l_quantity", 7)
    return bins.select("bin", F.round("low", 6).alias("low"), "count", F.round("share", 9).alias("share"))


@query(
    "latest_per_key",
    """SELECT user_id, event_id, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3""",
)
def latest_per_key(spark, t):
    return topk.latest_per_key(t.events, "user_id", "ts", 3, "event_id").select(
        "user_id", "event_id", "event_type"
    )


@query(
    "topk",
    """SELECT o_orderpriority, o_orderstatus, o_custkey, o_orderkey, o_totalprice FROM orders
       ORDER BY o_orderpriority DESC, o_orderstatus DESC, o_totalprice DESC, o_custkey DESC, o_orderkey DESC LIMIT 30""",
)
def top_rows(spark, t):
    keys = ["o_orderpriority", "o_orderstatus", "o_totalprice", "o_custkey", "o_orderkey"]
    return topk.top_n(t.orders, [F.col(k).desc() for k in keys], 30).select(*keys)


@query(
    "sort_nulls_last",
    """SELECT p_partkey, nullif(p_type, 'PROMO') AS kind FROM part ORDER BY kind ASC NULLS LAST, p_partkey""",
)
def sort_nulls_last(spark, t):
    rows = t.part.select("p_partkey", F.nullif(F.col("p_type"), F.lit("PROMO")).alias("kind"))
    return rows.orderBy(F.col("kind").asc_nulls_last(), "p_partkey")


@query("sort_multi", "SELECT ts, event_id, user_id FROM events ORDER BY ts DESC, event_id")
def sort_multi(spark, t):
    return t.events.select("ts", "event_id", "user_id").orderBy(F.col("ts").desc(), "event_id")


@query("limit_rows", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 10")
def limit_rows(spark, t):
    return t.events.select("event_id", "event_type").orderBy("event_id").limit(10)


@query(
    "union_all",
    """SELECT c_custkey AS id, c_name AS name, 'customer' AS kind FROM customer
       UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier
       UNION ALL SELECT p_partkey, p_name, 'part' FROM part""",
)
def union_all(spark, t):
    def side(df, prefix, kind):
        return df.select(
            F.col(f"{prefix}key").alias("id"), F.col(f"{prefix[0]}_name").alias("name"), F.lit(kind).alias("kind")
        )

    return topk.union_all(
        side(t.customer, "c_cust", "customer"), side(t.supplier, "s_supp", "supplier"), side(t.part, "p_part", "part")
    )


@query(
    "union_distinct",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct(spark, t):
    return topk.union_distinct(
        t.customer.select(F.col("c_nationkey").alias("nation")),
        t.supplier.select(F.col("s_nationkey").alias("nation")),
    )


@query(
    "temp_view",
    """SELECT p_brand, count(*) AS parts, sum(CAST(p_retailprice AS DECIMAL(18,2)))::DOUBLE AS price
       FROM part GROUP BY p_brand""",
)
def temp_view(spark, t):
    view = scratch_name("part")
    t.part.createOrReplaceTempView(view)
    return spark.sql(
        f"""SELECT p_brand, count(*) AS parts, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS price
            FROM {view} GROUP BY p_brand"""
    )


@query(
    "run_plugin",
    """SELECT *, md5(concat_ws('_', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment)) AS md5
       FROM (SELECT c_custkey, c_name, c_mktsegment FROM customer)""",
)
def plugin_run(spark, t):
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    table = scratch_name("hashed")
    run_plugin(spark, "md5", rows, {"path": scratch(spark, table)}, table)
    return spark.table(table)


@query(
    "effective_permissions",
    """WITH entries AS (
         SELECT DISTINCT 'lake/' || year(o_orderdate) || '/' || month(o_orderdate) || '/' AS path,
                o_orderpriority AS "group", o_orderstatus FROM orders)
       SELECT path, "group", w AS weight,
              CASE WHEN w >= 4 THEN 'r' ELSE '-' END || CASE WHEN w % 4 >= 2 THEN 'w' ELSE '-' END
                || CASE WHEN w % 2 = 1 THEN 'x' ELSE '-' END AS rights
       FROM (SELECT path, "group", sum(CASE o_orderstatus WHEN 'O' THEN 4 WHEN 'F' THEN 2 ELSE 1 END)::INTEGER AS w
             FROM entries GROUP BY ALL)""",
)
def effective_permissions(spark, t):
    return aggregates.effective_permissions(_permission_config(t), "lake/")


def _permission_config(t):
    """Order months as folders, priorities as groups, the status as the granted type.

    The collected lists are bounded: there are five priorities and three types.
    """
    kind = (
        F.when(F.col("o_orderstatus") == "O", "read").when(F.col("o_orderstatus") == "F", "write").otherwise("execute")
    )
    entries = t.orders.select(
        F.year("o_orderdate").cast("string").alias("year"),
        F.month("o_orderdate").cast("string").alias("month"),
        kind.alias("type"),
        "o_orderpriority",
    ).distinct()
    grants = entries.groupBy("year", "month", "type").agg(F.collect_list("o_orderpriority").alias("groups"))
    months = grants.groupBy("year", "month").agg(
        F.collect_list(F.struct("type", "groups")).alias("aclPermissions")
    )
    return months.select(F.array(F.struct("year", "month", "aclPermissions")).alias("datalakeProperties"))


@query(
    "permission_errors",
    """SELECT DISTINCT year(o_orderdate) || '/' || month(o_orderdate) || '/' AS path, o_orderpriority AS "group",
              'unknown group' AS error FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')""",
)
def permission_errors(spark, t):
    """Groups are known when they are among the urgent ones of the orders."""
    known = t.orders.where(F.col("o_orderpriority") < "4").select(F.col("o_orderpriority").alias("group"))
    return aggregates.permission_errors(_permission_config(t), known)


@query(
    "reconcile_counts",
    """SELECT i AS incoming, o AS outgoing, i <= o AS complete
       FROM (SELECT count(*) AS i FROM orders), (SELECT count(*) AS o FROM lineitem)""",
)
def reconcile_counts(spark, t):
    """Messages in (orders per day) against messages out (line items per day)."""
    incoming = t.orders.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("n"))
    outgoing = t.lineitem.groupBy("l_shipdate").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.reconcile(incoming, outgoing, "n")
