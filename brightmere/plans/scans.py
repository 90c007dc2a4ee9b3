"""Scans: every source format, on files Spark writes from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightmere.functions.calendar import timestamp_slots
from brightmere.operators import features
from brightmere.operators.load import by_partition
from brightmere.plans.registry import query
from brightmere.schemas import get_schema
from brightmere.session import scratch, scratch_name
from brightmere.sources import files, messages, versions

CUSTOMER = "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING"


def _customer_json(spark, t) -> str:
    """Customers as JSON lines; the lines of customers in debt are cut short."""
    path = scratch(spark, "json")
    line = F.to_json(F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))
    cut = F.when(F.col("c_acctbal") < 0, F.expr("substring(line, 1, length(line) - 4)")).otherwise(F.col("line"))
    t.customer.select(line.alias("line"), "c_acctbal").select(cut.alias("value")).write.text(path)
    return path


@query(
    "scan_json_schema",
    """SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 0""",
)
def scan_json_schema(spark, t):
    bad = scratch(spark, "json_bad")
    return files.read_json(spark, _customer_json(spark, t), CUSTOMER, bad_path=bad)


@query(
    "scan_json_corrupt",
    """SELECT count(*) AS diverted, sum(length(to_json({'c_custkey': c_custkey, 'c_name': c_name,
         'c_acctbal': c_acctbal, 'c_mktsegment': c_mktsegment})) - 4)::BIGINT AS characters
       FROM customer WHERE c_acctbal < 0""",
)
def scan_json_corrupt(spark, t):
    stored = scratch(spark, "json_bad")
    files.read_json(spark, _customer_json(spark, t), CUSTOMER, bad_path=stored)
    bad = spark.read.schema("source_file STRING, record STRING").json(stored)
    return bad.agg(
        F.count("source_file").alias("diverted"),
        F.sum(F.length("record")).alias("characters"),
    )


@query(
    "scan_json_infer",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
)
def scan_json_infer(spark, t):
    path = scratch(spark, "json")
    t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    ).write.json(path)
    return files.read_json(spark, path)


@query(
    "scan_jsonl",
    """SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
)
def scan_jsonl(spark, t):
    path = scratch(spark, "jsonl")
    body = F.struct("event_id", "event_type", F.from_json("props", "k INT").alias("props"))
    t.events.select(F.to_json(body)).write.text(path)
    layout = "event_id BIGINT, event_type STRING, props STRUCT<k: INT>"
    return files.read_json(spark, path, layout).select(
        "event_id", "event_type", F.col("props.k").alias("k")
    )


@query(
    "scan_nested_json",
    """SELECT 'spend' AS indicator_id, c_mktsegment AS country,
              strftime(o_orderdate, '%Y') AS date, CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS value
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def scan_nested_json(spark, t):
    path = scratch(spark, "nested")
    spend = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", F.date_format("o_orderdate", "yyyy").alias("date"))
        .agg(F.floor(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).cast("bigint").alias("value"))
    )
    spend.select(
        F.struct(F.lit("spend").alias("id"), F.lit("order value").alias("value")).alias("indicator"),
        F.struct(F.lit("").alias("id"), F.col("c_mktsegment").alias("value")).alias("country"),
        "date",
        "value",
    ).write.json(path)
    return files.indicator_facts(files.read_json(spark, path, get_schema("indicator")))


@query(
    "scan_csv_header",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
              c_mktsegment FROM customer""",
)
def scan_csv_header(spark, t):
    path = scratch(spark, "csv")
    t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").write.option(
        "header", True
    ).csv(path)
    return files.read_csv(spark, path)


@query(
    "scan_csv_infer",
    """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_size, p_retailprice FROM part""",
)
def scan_csv_infer(spark, t):
    path = scratch(spark, "csv")
    t.part.select("p_partkey", "p_name", "p_size", "p_retailprice").write.option("header", True).csv(path)
    return files.read_csv(spark, path, infer=True)


@query(
    "scan_csv_failfast",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem""",
)
def scan_csv_failfast(spark, t):
    path = scratch(spark, "csv")
    t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate").write.option(
        "header", True
    ).csv(path)
    layout = """l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_returnflag STRING,
                l_shipdate TIMESTAMP_NTZ"""
    return files.read_csv(spark, path, layout, mode="FAILFAST")


@query(
    "scan_csv_dialect",
    """SELECT p_partkey, '"' || p_name || '" | ' || p_brand AS label FROM part""",
)
def scan_csv_dialect(spark, t):
    path = scratch(spark, "csv")
    label = F.concat(F.lit('"'), "p_name", F.lit('" | '), "p_brand")
    dialect = {"sep": "|", "quote": '"', "escape": "\\"}
    t.part.select("p_partkey", label.alias("label")).write.options(header=True, **dialect).csv(path)
    return files.read_csv(spark, path, "p_partkey BIGINT, label STRING", **dialect)


@query(
    "scan_parquet",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1998-01-01'""",
)
def scan_parquet(spark, t):
    return t.lineitem.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )


@query(
    "scan_monthly_union",
    """SELECT o_orderkey, o_totalprice,
              CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority
       FROM orders""",
)
def scan_monthly_union(spark, t):
    """Orders as one folder per month; the months before 1998 lack a column."""
    root = scratch(spark, "monthly")
    dated = by_partition(t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM")), "month")
    early = F.col("month") < "1998-01"
    columns = ["o_orderkey", "o_totalprice", "month"]
    dated.where(early).select(*columns).write.partitionBy("month").parquet(f"{root}/early")
    dated.where(~early).select("o_orderpriority", *columns).write.partitionBy("month").parquet(f"{root}/late")
    months = [r[0] for r in t.orders.select(F.date_format("o_orderdate", "yyyy-MM")).distinct().collect()]
    sides = [(f"{root}/early" if m < "1998-01" else f"{root}/late", m) for m in months]
    return files.read_parquet_many(spark, [f"{side}/month={m}" for side, m in sides]).select(
        "o_orderkey", "o_totalprice", "o_orderpriority"
    )


@query(
    "scan_glob_view",
    """SELECT c_custkey, c_name FROM customer WHERE c_mktsegment LIKE 'M%'""",
)
def scan_glob_view(spark, t):
    root = scratch(spark, "glob")
    by_partition(t.customer, "c_mktsegment").write.partitionBy("c_mktsegment").parquet(root)
    view = scratch_name("customers")
    files.register_glob_view(spark, f"{root}/c_mktsegment=M*", view)
    return spark.sql(f"SELECT c_custkey, c_name FROM {view}")


def _orders_by_month(spark, t) -> str:
    """A catalog table of orders partitioned by year and month."""
    table = scratch_name("orders_by_month")
    dated = t.orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    by_partition(dated, "year", "month").write.partitionBy("year", "month").option(
        "path", scratch(spark, table)
    ).saveAsTable(table)
    return table


@query(
    "partition_view",
    """SELECT o_orderkey, o_totalprice, 1997 AS year, 5 AS month FROM orders
       WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 5""",
)
def partition_view(spark, t):
    view = files.create_partition_view(spark, _orders_by_month(spark, t), 1997, 5)
    return spark.table(view).select("o_orderkey", "o_totalprice", "year", "month")


@query("scan_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_table(spark, t):
    table = scratch_name("supplier")
    t.supplier.write.option("path", scratch(spark, table)).saveAsTable(table)
    return spark.read.table(table)


@query("scan_external_table", "SELECT p_partkey, p_brand, p_size FROM part")
def scan_external_table(spark, t):
    path = scratch(spark, "external")
    t.part.select("p_partkey", "p_brand", "p_size").write.parquet(path)
    return files.external_table(
        spark, scratch_name("part"), path, "p_partkey BIGINT, p_brand STRING, p_size INT"
    )


def _order_versions(spark, t) -> str:
    """Orders as a versioned table: up to 1996, 1997 and 1998, from 1999 on."""
    root = scratch(spark, "versions")
    year = F.year("o_orderdate")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    for batch in (year <= 1996, year.between(1997, 1998), year >= 1999):
        versions.commit(t.orders.where(batch).select(*columns), root)
    return root


@query(
    "read_version",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) <= 1998",
)
def read_version(spark, t):
    return versions.read_version(spark, _order_versions(spark, t), 1)


@query(
    "read_version_new_columns",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) <= 1998 THEN o_custkey END AS o_custkey,
              CASE WHEN year(o_orderdate) BETWEEN 1997 AND 1998 THEN o_totalprice END AS o_totalprice,
              CASE WHEN year(o_orderdate) >= 1999 THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def read_version_new_columns(spark, t):
    """Appends that bring columns and leave others out."""
    root, year = scratch(spark, "versions"), F.year("o_orderdate")
    batches = [
        (year <= 1996, ["o_orderkey", "o_custkey"]),
        (year.between(1997, 1998), ["o_orderkey", "o_custkey", "o_totalprice"]),
        (year >= 1999, ["o_orderpriority", "o_orderkey"]),
    ]
    for batch, columns in batches:
        versions.commit(t.orders.where(batch).select(*columns), root)
    return versions.read_version(spark, root)


@query(
    "table_history",
    """SELECT CASE WHEN year(o_orderdate) <= 1996 THEN 0 WHEN year(o_orderdate) <= 1998 THEN 1 ELSE 2 END::BIGINT AS version,
              'append' AS operation, count(*) AS rows FROM orders GROUP BY ALL""",
)
def table_history(spark, t):
    return versions.history(spark, _order_versions(spark, t)).select("version", "operation", "rows")


@query(
    "changes_since",
    """SELECT o_orderkey, o_custkey, o_totalprice,
              CASE WHEN year(o_orderdate) <= 1998 THEN 1 ELSE 2 END::BIGINT AS _commit_version
       FROM orders WHERE year(o_orderdate) >= 1997""",
)
def changes_since(spark, t):
    return versions.changes_since(spark, _order_versions(spark, t), 1)


@query(
    "inline_rows",
    """SELECT label, count(*) AS orders FROM orders
       JOIN (VALUES ('O', 'open'), ('F', 'finished'), ('P', 'partly done')) v(code, label)
         ON o_orderstatus = code GROUP BY label""",
)
def inline_rows(spark, t):
    labels = spark.createDataFrame(
        [("O", "open"), ("F", "finished"), ("P", "partly done")], "code STRING, label STRING"
    )
    return (
        t.orders.join(labels, F.col("o_orderstatus") == F.col("code"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    "range_random",
    "SELECT l_returnflag, count(*) AS rows, true AS in_range, true AS centred FROM lineitem GROUP BY l_returnflag",
)
def range_random(spark, t):
    """Every line item with a uniform and a normal random number; their range and means per flag."""
    drawn = t.lineitem.select("l_returnflag", F.rand(10).alias("uniform"), F.randn(27).alias("normal"))
    return drawn.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"),
        ((F.min("uniform") >= 0) & (F.max("uniform") < 1)).alias("in_range"),
        ((F.abs(F.avg("uniform") - 0.5) < 0.05) & (F.abs(F.avg("normal")) < 0.15)).alias("centred"),
    )


@query(
    "ts_sequence",
    """WITH slots AS (
         SELECT unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, (SELECT min(ts) FROM events)),
                                       (SELECT max(ts) FROM events), INTERVAL 15 MINUTE)) AS slot)
       SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, count(event_id) AS events
       FROM slots LEFT JOIN events ON time_bucket(INTERVAL 15 MINUTE, ts) = slot GROUP BY slot""",
)
def ts_sequence(spark, t):
    """Events per quarter hour, quarters without one included."""
    slots = timestamp_slots(t.events, "ts", 15)
    per_slot = t.events.groupBy(F.window("ts", "15 minutes").getField("start").alias("slot")).agg(
        F.count("event_id").alias("events")
    )
    return slots.join(per_slot, "slot", "left").select(
        F.date_format("slot", "yyyy-MM-dd HH:mm:ss").alias("slot"),
        F.coalesce("events", F.lit(0).cast("bigint")).alias("events"),
    )


@query(
    "stack_messages",
    """WITH pairs AS (
         SELECT o_orderkey AS ts, 0 AS position, 'status' AS name, o_orderstatus AS value, o_orderpriority FROM orders
         UNION ALL SELECT o_orderkey, 1, 'placed', substr(strftime(o_orderdate, '%H:%M'), 1, 2), o_orderpriority FROM orders
         UNION ALL SELECT o_orderkey, 2, 'checked', NULL, o_orderpriority FROM orders)
       SELECT '/orders/' || o_orderpriority AS topic, ts, position, name, value FROM pairs""",
)
def stack_messages(spark, t):
    return messages.stack_messages(_order_messages(t))


def _order_messages(t):
    """Orders as text messages: a plain pair, one with a second colon, and a bare name."""
    text = F.concat(
        F.lit("status:  "), "o_orderstatus",
        F.lit("\nplaced: "), F.date_format("o_orderdate", "HH:mm"),
        F.lit("\nchecked"),
    )
    return t.orders.select(
        F.concat(F.lit("/orders/"), "o_orderpriority").alias("topic"),
        F.col("o_orderkey").alias("ts"),
        text.alias("text"),
    )


@query(
    "topic_partition",
    """SELECT '_slash_' || p_type || '_slash_' || p_brand AS topic, count(*) AS messages
       FROM part GROUP BY ALL""",
)
def topic_partition(spark, t):
    topic = F.concat(F.lit("/"), "p_type", F.lit("/"), "p_brand")
    path = scratch(spark, "topics")
    messages.write_topics(t.part.select(topic.alias("topic"), "p_partkey", "p_name"), path)
    return spark.read.parquet(path).groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "topic_table",
    """SELECT CAST(o_orderkey AS VARCHAR) AS ts, o_orderstatus AS status, strftime(o_orderdate, '%H') AS placed, CAST(NULL AS VARCHAR) AS checked
       FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def topic_table(spark, t):
    """The urgent orders' messages as a table."""
    return messages.topic_table(_order_messages(t), "/orders/1-URGENT").withColumn("ts", F.col("ts").cast("string"))


@query(
    "topic_table_lines",
    """SELECT CAST(o_orderkey AS VARCHAR) AS ts, o_orderstatus AS status,
              CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS customer,
              CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS status_2 FROM orders""",
)
def topic_table_lines(spark, t):
    """Messages that differ in their lines: an even customer comes first, each third has two states."""
    text = F.concat(
        F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("customer: "), "o_custkey", F.lit("\n"))).otherwise(""),
        F.lit("status: "), "o_orderstatus",
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("\nstatus: "), "o_orderpriority")).otherwise(""),
    )
    sent = t.orders.select(F.lit("/orders").alias("topic"), F.col("o_orderkey").alias("ts"), text.alias("text"))
    return messages.topic_table(sent, "/orders").withColumn("ts", F.col("ts").cast("string"))


@query(
    "parse_access_log",
    """SELECT CAST(page_id AS VARCHAR) AS "client-request-id", url || ';v=' || page_id AS "request-url",
              CASE WHEN url LIKE 'https%' THEN '443' ELSE '80' END AS "service-type",
              CAST(length(html) AS VARCHAR) AS "response-packet-size"
       FROM pages""",
)
def parse_access_log(spark, t):
    """Page reads as log lines of 30 fields, the address quoted because it holds a ``;``."""
    path = scratch(spark, "access_log")
    given = {
        "request-url": F.concat(F.lit('"'), "url", F.lit(";v="), F.col("page_id"), F.lit('"')),
        "service-type": F.when(F.col("url").startswith("https"), "443").otherwise("80"),
        "response-packet-size": F.length("html").cast("string"),
        "client-request-id": F.col("page_id").cast("string"),
    }
    line = F.concat_ws(";", *[given.get(name, F.lit("-")) for name in messages.ACCESS_LOG_FIELDS])
    t.pages.select(line).write.text(path)
    return messages.parse_access_log(spark, path).select(*[f"`{c}`" for c in given])


@query(
    "access_log_json",
    """SELECT count(*) AS lines, count(DISTINCT url || ';v=' || page_id) AS urls FROM pages""",
)
def access_log_json(spark, t):
    """Log lines as JSON texts, read back."""
    bodies = messages.access_log_json(parse_access_log(spark, t))
    return bodies.agg(
        F.count("body").alias("lines"),
        F.countDistinct(F.get_json_object("body", "$.request-url")).alias("urls"),
    )


@query(
    "read_feature_set",
    """SELECT user_id, count(*)::INTEGER AS events, round(max(value), 2) AS top FROM events GROUP BY user_id""",
)
def read_feature_set(spark, t):
    """Two versions of a feature set; the newer one is read in its declared types."""
    registry = scratch(spark, "registry")
    layout = StructType.fromDDL("user_id BIGINT, events INT, top DOUBLE")
    per_user = t.events.groupBy("user_id").agg(
        F.count(F.lit(1)).cast("int").alias("events"), F.round(F.max("value"), 2).alias("top")
    )
    for version, fmt, rows in ((1, "parquet", per_user.where("events > 1")), (2, "csv", per_user)):
        path = scratch(spark, "features")
        rows.write.option("header", True).format(fmt).save(path)
        features.register(spark, registry, "users", path, layout, "top", ["user_id"], fmt, version)
    return features.read_feature_set(spark, registry, "users")
