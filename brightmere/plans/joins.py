"""Dimension loads, facts, look-ups, hierarchies and paths."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from brightmere.functions.calendar import day_id
from brightmere.functions.scalars import EMPTY_UUID, surrogate_key
from brightmere.functions.sqlfuncs import register_sql_functions
from brightmere.operators import facts, features, joins, scd
from brightmere.operators.standardize import stamp
from brightmere.plans.registry import query
from brightmere.session import scratch_name

FIRST, SECOND = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)
UUID = "regexp_replace(md5({0}), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\\1-\\2-\\3-\\4-\\5')"


def _uuid(*columns: str) -> str:
    """SQL of the surrogate key."""
    parts = " || ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns
    )
    return UUID.format(parts)


def _first_load(df, surrogate, keys):
    """A dimension as a first load would have left it."""
    return df.withColumn(surrogate, surrogate_key(*[F.col(k) for k in keys])).withColumns(stamp("first", FIRST))


def _loaded(df):
    return df.withColumn("loaded_on", F.date_format("loaded_on", "yyyy-MM-dd HH:mm:ss"))


@query(
    "scd1_upsert",
    f"""WITH old AS (SELECT {_uuid('o_orderkey')} AS id, o_orderkey, o_orderstatus, o_orderpriority
                     FROM orders WHERE year(o_orderdate) <= 1998),
             new AS (SELECT o_orderkey, 'checked ' || o_orderstatus AS o_orderstatus, lower(o_orderpriority) AS o_orderpriority
                     FROM orders WHERE year(o_orderdate) >= 1998)
        SELECT coalesce(old.id, {_uuid('new.o_orderkey')}) AS dim_order_id,
               coalesce(new.o_orderkey, old.o_orderkey) AS o_orderkey,
               CASE WHEN new.o_orderkey IS NULL THEN old.o_orderstatus ELSE new.o_orderstatus END AS o_orderstatus,
               CASE WHEN new.o_orderkey IS NULL THEN old.o_orderpriority ELSE new.o_orderpriority END AS o_orderpriority,
               CASE WHEN new.o_orderkey IS NULL THEN 'first' ELSE 'second' END AS load_id,
               CASE WHEN new.o_orderkey IS NULL THEN '2024-01-01 06:00:00' ELSE '2024-01-02 06:00:00' END AS loaded_on
        FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey""",
)
def scd1_upsert(spark, t):
    """Orders up to 1998 are in the dimension; those from 1998 on arrive, changed."""
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    year = F.year("o_orderdate")
    dim = _first_load(t.orders.where(year <= 1998).select(*columns), "dim_order_id", ["o_orderkey"])
    arriving = t.orders.where(year >= 1998).select(
        "o_orderkey",
        F.concat(F.lit("checked "), "o_orderstatus").alias("o_orderstatus"),
        F.lower("o_orderpriority").alias("o_orderpriority"),
    )
    return _loaded(
        scd.scd1_upsert(
            arriving, dim, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"], "dim_order_id", "second", SECOND
        )
    )


@query(
    "scd1_composite",
    f"""WITH old AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE year(l_shipdate) <= 1997),
             new AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE year(l_shipdate) >= 1997)
        SELECT {_uuid('coalesce(new.l_partkey, old.l_partkey)', 'coalesce(new.l_suppkey, old.l_suppkey)')} AS dim_source_id,
               coalesce(new.l_partkey, old.l_partkey) AS l_partkey, coalesce(new.l_suppkey, old.l_suppkey) AS l_suppkey,
               CASE WHEN new.l_partkey IS NULL THEN 'first' ELSE 'second' END AS load_id
        FROM old FULL JOIN new ON old.l_partkey = new.l_partkey AND old.l_suppkey = new.l_suppkey""",
)
def scd1_composite(spark, t):
    """The (part, supplier) pairs of two overlapping periods."""
    keys = ["l_partkey", "l_suppkey"]
    year = F.year("l_shipdate")
    dim = _first_load(t.lineitem.where(year <= 1997).select(*keys).distinct(), "dim_source_id", keys)
    arriving = t.lineitem.where(year >= 1997).select(*keys)
    return scd.scd1_upsert(
        arriving, dim, keys, [], "dim_source_id", "second", SECOND, duplicates="unique"
    ).select("dim_source_id", *keys, "load_id")


@query(
    "scd1_keyonly",
    f"""SELECT {_uuid('event_type')} AS dim_type_id, event_type,
              CASE WHEN max(ts) >= TIMESTAMP '2024-01-16' THEN 'second' ELSE 'first' END AS load_id
        FROM events GROUP BY event_type""",
)
def scd1_keyonly(spark, t):
    """Event types of the first half of the month, then those of the second."""
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    first = t.events.where(F.col("ts") < middle).select("event_type").distinct()
    dim = _first_load(first, "dim_type_id", ["event_type"])
    arriving = t.events.where(F.col("ts") >= middle)
    return scd.scd1_upsert(
        arriving, dim, ["event_type"], [], "dim_type_id", "second", SECOND, duplicates="unique"
    ).select("dim_type_id", "event_type", "load_id")


@query(
    "join_anti",
    """SELECT c_custkey, c_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01')""",
)
def join_anti(spark, t):
    """Customers without an order since 2001."""
    recent = t.orders.where(F.year("o_orderdate") >= 2001).select(F.col("o_custkey").alias("c_custkey"))
    return joins.only_in(t.customer, recent, ["c_custkey"]).select("c_custkey", "c_name")


@query(
    "join_matched",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0",
)
def join_matched(spark, t):
    solvent = t.customer.where(F.col("c_acctbal") > 0)
    return t.orders.join(solvent, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query(
    "join_new",
    """SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE year(l_shipdate) > 1999
       AND (l_partkey, l_suppkey) NOT IN (SELECT (l_partkey, l_suppkey) FROM lineitem WHERE year(l_shipdate) <= 1999)""",
)
def join_new(spark, t):
    """(part, supplier) pairs seen for the first time after 1999."""
    keys = ["l_partkey", "l_suppkey"]
    year = F.year("l_shipdate")
    arriving = t.lineitem.where(year > 1999).select(*keys).distinct()
    return joins.only_in(arriving, t.lineitem.where(year <= 1999), keys)


@query(
    "fact_star",
    f"""SELECT strftime(l_shipdate, '%Y%m%d') AS dim_date_id,
              coalesce(CASE WHEN o.o_orderkey IS NOT NULL THEN {_uuid('o.o_orderkey')} END, '{EMPTY_UUID}') AS dim_order_id,
              coalesce(CASE WHEN p.p_partkey IS NOT NULL THEN {_uuid('p.p_partkey')} END, '{EMPTY_UUID}') AS dim_part_id,
              coalesce(CASE WHEN s.s_suppkey IS NOT NULL THEN {_uuid('s.s_suppkey')} END, '{EMPTY_UUID}') AS dim_supplier_id,
              l_linenumber, l_extendedprice
       FROM lineitem
       LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o.o_orderkey
       LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') p ON l_partkey = p.p_partkey
       LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) s ON l_suppkey = s.s_suppkey""",
)
def fact_star(spark, t):
    """Line items as facts of orders, parts and suppliers. Partly done orders, promotional
    parts and suppliers in debt are not in their dimensions: their lines get the unknown member."""
    orders = t.orders.where(F.col("o_orderstatus") != "P").select(
        "o_orderkey", surrogate_key(F.col("o_orderkey")).alias("dim_order_id")
    )
    part = t.part.where(F.col("p_type") != "PROMO").select(
        "p_partkey", surrogate_key(F.col("p_partkey")).alias("dim_part_id")
    )
    supplier = t.supplier.where(F.col("s_acctbal") >= 0).select(
        "s_suppkey", surrogate_key(F.col("s_suppkey")).alias("dim_supplier_id")
    )
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", day_id(F.col("l_shipdate")).alias("dim_date_id")
    )
    return facts.star_fact(
        lines,
        [
            (orders, {"l_orderkey": "o_orderkey"}, "dim_order_id"),
            (part, {"l_partkey": "p_partkey"}, "dim_part_id"),
            (supplier, {"l_suppkey": "s_suppkey"}, "dim_supplier_id"),
        ],
    ).select("dim_date_id", "dim_order_id", "dim_part_id", "dim_supplier_id", "l_linenumber", "l_extendedprice")


@query(
    "join_left",
    """SELECT o_orderkey, c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def join_left(spark, t):
    solvent = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.enrich(t.orders, solvent, "o_custkey").select("o_orderkey", "c_name")


@query(
    "join_calendar",
    """WITH e AS (SELECT day(ts) AS d, hour(ts) AS h, count(*) AS events FROM events GROUP BY ALL),
            o AS (SELECT day(o_orderdate) AS d, month(o_orderdate) AS m, count(*) AS orders FROM orders GROUP BY ALL)
       SELECT d AS day, h AS hour, m AS month, events, orders FROM e JOIN o USING (d) WHERE m = 1""",
)
def join_calendar(spark, t):
    """Events per hour of January with the orders of that calendar day."""
    events = t.events.groupBy(
        F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour")
    ).agg(F.count(F.lit(1)).alias("events"))
    orders = t.orders.groupBy(F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return joins.calendar_join(events, orders, {"month": "m", "day": "d"}).select(
        *[F.col(c).cast("bigint").alias(c) for c in ("day", "hour", "month")], "events", "orders"
    )


@query(
    "join_chain",
    """SELECT n_name, o_orderpriority, count(*) AS lines, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS revenue
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def join_chain(spark, t):
    """Revenue by nation. Line items are summed per order before they meet the others."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue")
    )
    return (
        per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "o_orderpriority")
        .agg(F.sum("lines").alias("lines"), F.sum("revenue").cast("double").alias("revenue"))
    )


PART_TREE = """SELECT p_partkey AS id, p_name || ' ' || p_partkey AS name,
                      CASE WHEN p_partkey > 0 THEN p_partkey // 10 END AS parent FROM part"""


def _part_tree(t):
    """Parts as a tree: each number belongs below the number without its last digit."""
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("name"),
        F.when(F.col("p_partkey") > 0, F.floor(F.col("p_partkey") / 10)).alias("parent"),
    )


@query(
    "join_parent",
    f"""WITH tree AS ({PART_TREE})
        SELECT c.id, c.name, c.parent, p.name AS parent_name FROM tree c JOIN tree p ON c.parent = p.id""",
)
def join_parent(spark, t):
    return joins.parents(_part_tree(t), "id", "parent", "name")


@query(
    "hierarchy_recursive",
    f"""WITH RECURSIVE nodes AS ({PART_TREE}), tree AS (
          SELECT id, name, parent, 0 AS level FROM nodes WHERE parent IS NULL
          UNION ALL SELECT n.id, n.name, n.parent, tree.level + 1 FROM nodes n JOIN tree ON n.parent = tree.id)
        SELECT tree.id, tree.name, tree.parent, p.name AS parent_name, tree.level
        FROM tree JOIN nodes p ON tree.parent = p.id""",
)
def hierarchy_recursive(spark, t):
    return joins.hierarchy(_part_tree(t), "id", "parent", "name")


# Parts in several assemblies: below the number without its last digit, those divisible by 3 also
# below their fourth part, those divisible by 5 twice below their third part.
PART_GRAPH = f"""{PART_TREE} UNION ALL SELECT p_partkey, p_name || ' ' || p_partkey || ' b', p_partkey // 4 FROM part WHERE p_partkey % 3 = 0 AND p_partkey > 9
    UNION ALL SELECT p_partkey, p_name || ' ' || p_partkey || ' c' || n, p_partkey // 3 FROM part, (VALUES (1), (2)) t(n) WHERE p_partkey % 5 = 0 AND p_partkey > 9"""


def _part_graph(t):
    def more(mark, n, divisor):
        held = t.part.where((F.col("p_partkey") % n == 0) & (F.col("p_partkey") > 9))
        name = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"), F.lit(mark))
        return held.select(F.col("p_partkey").alias("id"), name.alias("name"), F.floor(F.col("p_partkey") / divisor).alias("parent"))

    return _part_tree(t).union(more("b", 3, 4)).union(more("c1", 5, 3)).union(more("c2", 5, 3))


@query(
    "hierarchy_paths",
    f"""WITH RECURSIVE nodes AS ({PART_GRAPH}), tree AS (
          SELECT id, name, parent, CAST(NULL AS VARCHAR) AS parent_name, 0 AS level FROM nodes WHERE parent IS NULL
          UNION ALL SELECT n.id, n.name, n.parent, tree.name, tree.level + 1 FROM nodes n JOIN tree ON n.parent = tree.id)
        SELECT * FROM tree WHERE level > 0""",
)
def hierarchy_paths(spark, t):
    """Every path to a part that lies in several assemblies."""
    return joins.hierarchy(_part_graph(t), "id", "parent", "name")


@query(
    "all_categories",
    f"""WITH tree AS ({PART_TREE})
        SELECT p.name AS "ParentProductCategoryName", c.name AS "ProductCategoryName", c.id AS "ProductCategoryID"
        FROM tree c JOIN tree p ON c.parent = p.id""",
)
def all_categories(spark, t):
    """The same hierarchy through the SQL table function."""
    view = scratch_name("categories")
    _part_tree(t).select(
        F.col("id").alias("ProductCategoryID"),
        F.col("parent").alias("ParentProductCategoryID"),
        F.col("name").alias("Name"),
    ).createOrReplaceTempView(view)
    register_sql_functions(spark, categories=view)
    return spark.sql("SELECT * FROM all_categories()")


@query(
    "graph_two_hop",
    """SELECT c_custkey, c_mktsegment, o_orderkey, s_suppkey, s_name
       FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
       JOIN supplier ON l_suppkey = s_suppkey""",
)
def graph_two_hop(spark, t):
    placed = t.orders.select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"))
    supplied = t.lineitem.select(F.col("l_orderkey").alias("src"), F.col("l_suppkey").alias("dst"))
    return joins.graph_path(
        [
            t.customer.select("c_custkey", "c_mktsegment"),
            t.orders.select("o_orderkey"),
            t.supplier.select("s_suppkey", "s_name"),
        ],
        [placed, supplied],
        ["c_custkey", "o_orderkey", "s_suppkey"],
    ).select("c_custkey", "c_mktsegment", "o_orderkey", "s_suppkey", "s_name")


@query(
    "correlate_events",
    """WITH first AS (SELECT user_id, min(ts) AS started FROM events WHERE event_type = 'signup' GROUP BY user_id)
       SELECT e.user_id, event_id, ts, started AS start_ts FROM events e JOIN first f ON e.user_id = f.user_id
       WHERE event_type = 'purchase'""",
)
def correlate_events(spark, t):
    """Purchases with the first sign-up of their user."""
    signup = t.events.where(F.col("event_type") == "signup")
    purchase = t.events.where(F.col("event_type") == "purchase")
    return joins.correlate(signup, purchase, ["user_id"], "ts").select("user_id", "event_id", "ts", "start_ts")


@query(
    "fk_orphans",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)""",
)
def fk_orphans(spark, t):
    """Orders whose customer is not among the solvent ones."""
    solvent = t.customer.where(F.col("c_acctbal") >= 0)
    return joins.orphans(t.orders, solvent, {"o_custkey": "c_custkey"}).select("o_orderkey", "o_custkey")


@query(
    "ordinal_encode",
    """SELECT p_name, (dense_rank() OVER (ORDER BY first) - 1)::INTEGER AS code
       FROM (SELECT p_name, min(p_partkey) AS first FROM part GROUP BY p_name)""",
)
def ordinal_encode(spark, t):
    return features.ordinal_encode(t.part, "p_name", "p_partkey")
