"""Standardising loads and table writes."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

from pyspark.sql import Observation
from pyspark.sql import functions as F

from brightmere.operators import lineage, load, scd
from brightmere.operators.facts import process_fact_parking
from brightmere.operators.standardize import standardize_parking_bay, standardize_sensordata
from brightmere.plans.registry import query
from brightmere.plans.relational import total
from brightmere.schemas import get_schema
from brightmere.session import scratch, scratch_name
from brightmere.sources import versions

LOADED_ON = dt.datetime(2024, 3, 1, 18, 30, 0)

BAYS = """SELECT CASE WHEN o_orderstatus = 'F' THEN 'bay ' ELSE '' END || o_custkey AS bay_id,
                 CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE strftime(o_orderdate, '%Y%m%d%H%M%S') END AS last_edit,
                 CAST(o_orderkey AS VARCHAR) AS marker_id, o_orderpriority AS meter_id,
                 CAST(o_custkey AS VARCHAR) || CASE WHEN o_orderpriority = '1-URGENT' THEN '?' ELSE '' END AS rd_seg_id
          FROM orders"""
DEDUPED = f"""SELECT *, try_strptime(last_edit, '%Y%m%d%H%M%S') AS edited FROM ({BAYS})
              QUALIFY row_number() OVER (PARTITION BY bay_id ORDER BY try_strptime(last_edit, '%Y%m%d%H%M%S') DESC NULLS LAST,
                                         marker_id DESC, meter_id DESC, last_edit DESC, rd_seg_id DESC) = 1"""
TYPED = f"""SELECT CAST(try_cast(bay_id AS INTEGER) AS VARCHAR) AS bay_id, edited AS last_edit, marker_id, meter_id,
                   CAST(try_cast(rd_seg_id AS INTEGER) AS VARCHAR) AS rd_seg_id, 'load-1' AS load_id,
                   TIMESTAMP '2024-03-01 18:30:00' AS loaded_on FROM ({DEDUPED})"""


def _bays(t):
    """Orders as landed parking bays: the customer is the bay, its newest order the bay's state.

    Numbers of finished orders carry a word, low orders no edit time, and urgent ones a
    segment that is no number.
    """
    return _bay_rows(t.orders)


def _bay_rows(orders):
    return orders.select(
        F.lit(None).cast(
            "STRUCT<coordinates: ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>, type: STRING>"
        ).alias("the_geom"),
        F.col("o_orderkey").cast("string").alias("marker_id"),
        F.col("o_orderpriority").alias("meter_id"),
        F.concat(F.when(F.col("o_orderstatus") == "F", "bay ").otherwise(""), "o_custkey").alias("bay_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "unknown")
        .otherwise(F.date_format("o_orderdate", "yyyyMMddHHmmss"))
        .alias("last_edit"),
        F.concat(
            "o_custkey", F.when(F.col("o_orderpriority") == "1-URGENT", "?").otherwise("")
        ).alias("rd_seg_id"),
        F.lit(None).cast("string").alias("rd_seg_dsc"),
    )


def _shown(df):
    """The columns to compare; numbers that may be missing as text."""
    kinds = {"last_edit": "timestamp_ntz", "loaded_on": "timestamp_ntz", "bay_id": "string", "rd_seg_id": "string"}
    return df.drop("the_geom", "rd_seg_dsc").withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})


@query("standardize_good", f"SELECT * FROM ({TYPED}) WHERE bay_id IS NOT NULL")
def standardize_good(spark, t):
    return _shown(standardize_parking_bay(_bays(t), "load-1", LOADED_ON)[0])


@query("standardize_bad", f"SELECT * FROM ({TYPED}) WHERE bay_id IS NULL")
def standardize_bad(spark, t):
    return _shown(standardize_parking_bay(_bays(t), "load-1", LOADED_ON)[1])


SENSORS = """SELECT CAST(try_cast(CASE WHEN event_type = 'error' THEN 'n' || user_id ELSE '' || user_id END AS INTEGER) AS VARCHAR) AS bay_id,
                    CASE WHEN event_type <> 'view' THEN event_type END AS st_marker_id,
                    value >= 20 AS far, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS lon,
                    'load-1' AS load_id, count(*) AS events
             FROM events GROUP BY ALL"""


def _sensors(t):
    """Events as landed sensor rows: errors have no proper bay, views no marker."""
    return t.events.select(
        F.concat(F.when(F.col("event_type") == "error", "n").otherwise(""), "user_id").alias("bay_id"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("st_marker_id"),
        F.when(F.col("value") > 100, "Present").otherwise("Unoccupied").alias("status"),
        F.lit(None).cast("STRUCT<coordinates: ARRAY<DOUBLE>, type: STRING>").alias("location"),
        F.col("value").cast("string").alias("lat"),
        F.get_json_object("props", "$.k").alias("lon"),
    )


def _sensor_counts(df):
    bay = F.col("bay_id").cast("string").alias("bay_id")
    return df.groupBy(bay, "st_marker_id", (F.col("lat") >= 20).alias("far"), F.col("lon").cast("double").alias("lon"), "load_id").agg(
        F.count(F.lit(1)).alias("events")
    )


@query("standardize_events_good", f"SELECT * FROM ({SENSORS}) WHERE bay_id IS NOT NULL")
def standardize_events_good(spark, t):
    return _sensor_counts(standardize_sensordata(_sensors(t), "load-1", LOADED_ON)[0])


@query("standardize_events_bad", f"SELECT * FROM ({SENSORS}) WHERE bay_id IS NULL")
def standardize_events_bad(spark, t):
    return _sensor_counts(standardize_sensordata(_sensors(t), "load-1", LOADED_ON)[1])


@query(
    "parking_load",
    """SELECT '20240301' AS dim_date_id, 19800 AS dim_time_id,
              st_marker_id IS NULL AS marker_unknown,
              user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F') AS bay_unknown, location_unknown,
              status, count(*) AS facts
       FROM (SELECT CASE WHEN event_type <> 'view' THEN event_type END AS st_marker_id, user_id,
                    value IS NULL OR json_extract_string(props, '$.k') IS NULL AS location_unknown,
                    CASE WHEN value > 100 THEN 'Present' ELSE 'Unoccupied' END AS status
             FROM events WHERE event_type <> 'error') GROUP BY ALL""",
)
def parking_load(spark, t):
    """The whole load: standardised bays and sensors, three dimensions, facts; counted by status."""
    fact, _ = _parking(spark, _bays(t), _sensors(t), _no_dims(spark), "load-1")
    unknown = F.lit("00000000-0000-0000-0000-000000000000")
    return fact.groupBy(
        "dim_date_id",
        "dim_time_id",
        (F.col("dim_st_marker_id") == unknown).alias("marker_unknown"),
        (F.col("dim_parking_bay_id") == unknown).alias("bay_unknown"),
        (F.col("dim_location_id") == unknown).alias("location_unknown"),
        "status",
    ).agg(F.count(F.lit(1)).alias("facts"))


def _no_dims(spark):
    return [spark.createDataFrame([], get_schema(f"dw_dim_{n}")) for n in ("parking_bay", "location", "st_marker")]


def _parking(spark, landed_bays, landed_sensors, dims, load_id):
    """Facts and dimensions of a load upon the dimensions there were. Standardised rows and
    dimensions are stored as they are made, and each later step reads them."""
    path = scratch(spark, "parking")

    def stored(rows, name):
        rows.write.parquet(f"{path}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}")

    bays = stored(standardize_parking_bay(landed_bays, load_id, LOADED_ON)[0], "interim_bay")
    sensors = stored(standardize_sensordata(landed_sensors, load_id, LOADED_ON)[0], "interim_sensor")
    made = [
        stored(scd.process_dim_parking_bay(bays, dims[0], load_id, LOADED_ON), "dim_bay"),
        stored(scd.process_dim_location(sensors, dims[1], load_id, LOADED_ON), "dim_location"),
        stored(scd.process_dim_st_marker(sensors, dims[2], load_id, LOADED_ON), "dim_marker"),
    ]
    return process_fact_parking(sensors, *made, load_id, LOADED_ON), made


@query(
    "parking_facts_reload",
    """WITH bays AS (SELECT DISTINCT o_custkey, year(o_orderdate) <= 1993 AS early FROM orders
                     WHERE o_orderstatus <> 'F' AND (year(o_orderdate) <= 1993 OR year(o_orderdate) >= 1996)),
            sensors AS (SELECT *, CASE WHEN event_type <> 'view' THEN event_type END AS marker FROM events WHERE event_type <> 'error')
       SELECT 'load-1' AS load_id, user_id NOT IN (SELECT o_custkey FROM bays WHERE early) AS bay_unknown, marker IS NULL AS marker_unknown,
              count(*) AS facts, count(DISTINCT marker) AS markers
       FROM sensors WHERE event_type <> 'purchase' AND user_id % 2 = 0 GROUP BY ALL
       UNION ALL SELECT 'load-2', user_id NOT IN (SELECT o_custkey FROM bays), marker IS NULL, count(*), count(DISTINCT marker)
       FROM sensors GROUP BY ALL""",
)
def parking_facts_reload(spark, t):
    """Facts of two loads. The second finds dimensions that the first has filled: bays that only
    the first brought are still known, new bays and markers are known from it on."""
    year = F.year("o_orderdate")
    dims, loads = _no_dims(spark), []
    for number, orders, events in (
        (1, t.orders.where(year <= 1993), t.events.where("event_type <> 'purchase' AND user_id % 2 = 0")),
        (2, t.orders.where(year >= 1996), t.events),
    ):
        fact, dims = _parking(spark, _bay_rows(orders), _sensors(SimpleNamespace(events=events)), dims, f"load-{number}")
        loads.append(fact)
    unknown = F.lit("00000000-0000-0000-0000-000000000000")
    marker = F.when(F.col("dim_st_marker_id") != unknown, F.col("dim_st_marker_id"))
    return loads[0].unionByName(loads[1]).groupBy(
        "load_id", (F.col("dim_parking_bay_id") == unknown).alias("bay_unknown"), marker.isNull().alias("marker_unknown")
    ).agg(F.count(F.lit(1)).alias("facts"), F.countDistinct(marker).alias("markers"))


FIRST, SECOND = "year(o_orderdate) <= 1997", "year(o_orderdate) >= 1995"
GOOD = {x: f"SELECT * FROM ({TYPED.replace('FROM orders', f'FROM orders WHERE {x}')}) WHERE bay_id IS NOT NULL" for x in (FIRST, SECOND)}


@query(
    "parking_reload",
    f"""WITH old AS ({GOOD[FIRST]}), new AS ({GOOD[SECOND]})
        SELECT bay_id, marker_id, meter_id, rd_seg_id, 'load-2' AS load_id FROM new
        UNION ALL SELECT bay_id, marker_id, meter_id, rd_seg_id, 'load-1' FROM old WHERE bay_id NOT IN (SELECT bay_id FROM new)""",
)
def parking_reload(spark, t):
    """The bays after a second load, which changes some, adds some and lacks some."""
    path = scratch(spark, "bays")
    dim = spark.createDataFrame([], get_schema("dw_dim_parking_bay"))
    for number, chosen in ((1, F.year("o_orderdate") <= 1997), (2, F.year("o_orderdate") >= 1995)):
        landed, _ = standardize_parking_bay(_bay_rows(t.orders.where(chosen)), f"load-{number}", LOADED_ON)
        scd.process_dim_parking_bay(landed, dim, f"load-{number}", LOADED_ON).write.parquet(f"{path}/{number}")
        dim = spark.read.schema(dim.schema).parquet(f"{path}/{number}")
    texts = [F.col(c).cast("string").alias(c) for c in ("bay_id", "rd_seg_id")]
    return dim.select(*texts, "marker_id", "meter_id", "load_id")


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice"]
PLAIN = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"


def _halves(t):
    """Orders up to 1997, and later ones."""
    year = F.year("o_orderdate")
    rows = t.orders
    return (rows.where(year <= 1997).select(*ORDER_COLUMNS), rows.where(year > 1997).select(*ORDER_COLUMNS))


def _saved(spark, df, label: str, *partitions: str) -> str:
    """A new catalog table with the rows of ``df``."""
    table = scratch_name(label)
    rows = load.by_partition(df, *partitions) if partitions else df
    writer = rows.write.option("path", scratch(spark, table))
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(table)
    return table


@query("append_into", PLAIN)
def append_into(spark, t):
    """The later rows arrive with their columns in another order."""
    first, later = _halves(t)
    table = _saved(spark, first, "orders")
    load.append_into(later.select("o_totalprice", "o_orderkey", "o_custkey"), table)
    return spark.table(table)


@query("append_path", PLAIN)
def append_path(spark, t):
    path = scratch(spark, "orders")
    for half in _halves(t):
        load.append_path(half, path)
    return spark.read.parquet(path)


@query(
    "overwrite_self",
    "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def overwrite_self(spark, t):
    table = _saved(spark, t.orders.select(*ORDER_COLUMNS), "orders")
    solvent = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"))
    changed = spark.table(table).join(solvent, "o_custkey", "left_semi").withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    load.overwrite_self(spark, changed, table)
    return spark.table(table)


@query(
    "save_reference",
    "SELECT n_nationkey, n_name, true AS open_now, '2099-12-31 23:59:59' AS valid_till FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL",
)
def save_reference(spark, t):
    """The nations of the customers, saved twice, the second time with other columns."""
    table = scratch_name("nations")
    nations = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    path = scratch(spark, table)
    load.save_reference(nations.select("n_nationkey").distinct(), table, path)
    load.save_reference(nations.select("n_nationkey", "n_name").distinct(), table, path)
    return spark.table(table).select(
        "n_nationkey",
        "n_name",
        (F.col("valid_from") <= F.current_timestamp()).alias("open_now"),
        F.date_format("valid_till", "yyyy-MM-dd HH:mm:ss").alias("valid_till"),
    )


@query("create_or_append", PLAIN)
def create_or_append(spark, t):
    table = scratch_name("orders")
    path = scratch(spark, table)
    done = [load.create_or_append(half, table, path) for half in _halves(t)]
    if done != ["created", "appended"]:
        raise AssertionError(done)
    return spark.table(table)


@query(
    "truncate_load",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, CAST(o_totalprice AS BIGINT) AS o_totalprice FROM (SELECT o_orderkey, o_custkey, trunc(o_totalprice) AS o_totalprice FROM orders WHERE year(o_orderdate) > 1997)",
)
def truncate_load(spark, t):
    casts = {"o_orderkey": "string", "o_totalprice": "bigint"}
    first, later = (h.withColumn("o_totalprice", F.floor("o_totalprice").cast("double")) for h in _halves(t))
    table = _saved(spark, first.withColumns({c: F.col(c).cast(k) for c, k in casts.items()}), "orders")
    load.truncate_load(later, table, casts)
    return spark.table(table)


def _loads(t):
    """Orders with their year as the load."""
    return t.orders.select(*ORDER_COLUMNS, F.date_format("o_orderdate", "yyyy").alias("load_id"))


@query(
    "reload_idempotent",
    """SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y') AS load_id
       FROM orders WHERE year(o_orderdate) <> 2000""",
)
def reload_idempotent(spark, t):
    """One load written twice, another replaced by nothing."""
    table = _saved(spark, _loads(t), "orders", "load_id")
    for _ in range(2):
        load.reload_idempotent(_loads(t), table, "1998")
    load.reload_idempotent(_loads(t).where(F.lit(False)), table, "2000")
    return spark.table(table)


@query(
    "load_dw",
    """SELECT 'dim' AS kind, load_id, count(*) AS rows FROM (SELECT 'all' AS load_id FROM customer) GROUP BY ALL
       UNION ALL SELECT 'fact', strftime(o_orderdate, '%Y'), count(*) FROM orders GROUP BY ALL""",
)
def load_dw(spark, t):
    """Customers in full and the loads 1996 and 1997 of the orders, each run twice."""
    customers = t.customer.select("c_custkey", "c_name")
    dim = _saved(spark, customers, "customers")
    fact = _saved(spark, _loads(t), "orders", "load_id")
    for year in ("1996", "1997", "1996", "1997"):
        load.load_dw(spark, {dim: (customers, {"c_custkey": "bigint"})}, {fact: _loads(t)}, year)
    dims = spark.table(dim).select(F.lit("dim").alias("kind"), F.lit("all").alias("load_id"))
    facts = spark.table(fact).select(F.lit("fact").alias("kind"), "load_id")
    return dims.unionByName(facts).groupBy("kind", "load_id").agg(F.count(F.lit(1)).alias("rows"))


@query("seed_if_empty", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) <= 1997")
def seed_if_empty(spark, t):
    """The second seed finds rows and does nothing."""
    first, later = _halves(t)
    table = _saved(spark, first.where(F.lit(False)), "orders")
    done = [load.seed_if_empty(half, table) for half in (first, later)]
    if done != [True, False]:
        raise AssertionError(done)
    return spark.table(table)


@query(
    "create_tables",
    """SELECT 'segments' AS name, 'c_mktsegment' AS first_column, count(DISTINCT c_mktsegment) AS rows FROM customer
       UNION ALL SELECT 'totals', 'o_custkey', count(DISTINCT o_custkey) FROM orders""",
)
def create_tables(spark, t):
    """One table from a data file, one from a statement, and a faulty entry that is reported."""
    data, segments, totals = scratch(spark, "segments"), scratch_name("segments"), scratch_name("totals")
    t.customer.select("c_mktsegment").distinct().write.option("header", True).csv(data)
    spec = {
        "table_types": [
            {"type": "reference", "tables": [{"table_name": segments, "data_file": data}]},
            {
                "type": "fact",
                "tables": [
                    {"table_name": totals, "create_sql": f"CREATE TABLE {totals} (o_custkey BIGINT, n BIGINT) USING parquet"
                                                         f" LOCATION '{scratch(spark, totals)}'"},
                    {"table_name": scratch_name("neither")},
                ],
            },
        ]
    }
    try:
        load.create_tables(spark, spec, scratch(spark, "tables"))
    except ValueError as faults:
        if "neither" not in str(faults):
            raise
    load.append_into(t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), totals)
    frames = [
        spark.table(name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(label).alias("name"), F.lit(spark.table(name).columns[0]).alias("first_column"), "rows"
        )
        for label, name in (("segments", segments), ("totals", totals))
    ]
    return frames[0].unionByName(frames[1])


@query(
    "write_roundtrip",
    """SELECT format, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS price
       FROM orders, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) v(format) GROUP BY format""",
)
def write_roundtrip(spark, t):
    """The same rows through four file formats."""
    layout = "o_orderkey BIGINT, o_totalprice DOUBLE"
    read = []
    for fmt in ("csv", "json", "orc", "parquet"):
        path = scratch(spark, fmt)
        t.orders.select("o_orderkey", "o_totalprice").write.format(fmt).save(path)
        read.append(spark.read.schema(layout).format(fmt).load(path).withColumn("format", F.lit(fmt)))
    stacked = read[0].unionByName(read[1]).unionByName(read[2]).unionByName(read[3])
    return stacked.groupBy("format").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"), total("o_totalprice").alias("price")
    )


def _converted(spark, t):
    """Orders through text, of which low ones have a customer that is no number: where the rest
    went, where the rejected rows went, and how many those are."""
    source, target = scratch(spark, "csv"), scratch(spark, "parquet")
    customer = F.when(F.col("o_orderpriority") == "5-LOW", "none").otherwise(F.col("o_custkey").cast("string"))
    t.orders.select("o_orderkey", "o_totalprice", customer.alias("o_custkey")).write.option("header", True).csv(source)
    casts = {"o_orderkey": "bigint", "o_totalprice": "double", "o_custkey": "bigint"}
    rejects = scratch(spark, "rejects")
    return target, rejects, load.convert(spark, f"{source}/*.csv", target, casts, rejects)


@query(
    "convert_csv_parquet",
    "SELECT o_orderkey, o_totalprice, o_custkey FROM orders WHERE o_orderpriority <> '5-LOW'",
)
def convert_csv_parquet(spark, t):
    return spark.read.parquet(_converted(spark, t)[0])


@query(
    "convert_rejects",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 'none' AS o_custkey, 'o_custkey' AS failed,
              (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW') AS rejected
       FROM orders WHERE o_orderpriority = '5-LOW'""",
)
def convert_rejects(spark, t):
    _, rejects, rejected = _converted(spark, t)
    failed = F.concat_ws(",", "_failed").alias("failed")
    return spark.read.parquet(rejects).select("o_orderkey", "o_custkey", failed, F.lit(rejected).cast("bigint").alias("rejected"))


@query("convert_to_versioned", PLAIN)
def convert_to_versioned(spark, t):
    source, root = scratch(spark, "parquet"), scratch(spark, "versioned")
    t.orders.select(*ORDER_COLUMNS).write.parquet(source)
    versions.convert_to_versioned(spark, source, root)
    return versions.read_version(spark, root, 0)


@query(
    "merge_files",
    "SELECT count(*) AS rows, sum(s_suppkey)::BIGINT AS keys, 1::BIGINT AS files FROM supplier",
)
def merge_files(spark, t):
    """Suppliers as one file per nation, made into one file."""
    source, target = scratch(spark, "many"), scratch(spark, "one")
    t.supplier.select("s_suppkey", "s_nationkey").repartition("s_nationkey").write.parquet(source)
    load.merge_files(spark, source, target)
    merged = spark.read.parquet(target).select("s_suppkey", F.col("_metadata.file_path").alias("file"))
    return merged.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("s_suppkey").alias("keys"), F.countDistinct("file").alias("files")
    )


@query("dated_snapshot", PLAIN)
def dated_snapshot(spark, t):
    """Two copies of one day: the second replaces the first."""
    root = scratch(spark, "snapshots")
    first, _ = _halves(t)
    for rows in (first, t.orders.select(*ORDER_COLUMNS)):
        path = load.dated_snapshot(rows, root, "orders", LOADED_ON.date())
    return spark.read.parquet(path)


@query(
    "audit_counts",
    "SELECT 'orders' AS filename, 'run-1' AS pipeline_run_id, count(*) AS count FROM orders UNION ALL SELECT 'lineitem', 'run-1', count(*) FROM lineitem",
)
def audit_counts(spark, t):
    path = scratch(spark, "audit")
    for name in ("orders", "lineitem"):
        load.append_path(load.audit_counts(getattr(t, name), name, "run-1"), path)
    return spark.read.parquet(path).drop("date")


@query("insert_only", "SELECT o_orderkey, o_custkey, 'processed' AS status FROM orders")
def insert_only(spark, t):
    rows = t.orders.select("o_orderkey", "o_custkey")
    table = _saved(spark, rows.withColumn("status", F.lit("")).where(F.lit(False)), "processed")
    load.insert_only(rows, table)
    return spark.table(table)


@query(
    "ctas",
    "SELECT o_orderpriority, count(*) AS orders, min(o_orderkey) AS first_order FROM orders GROUP BY o_orderpriority",
)
def ctas(spark, t):
    view, table = scratch_name("orders"), scratch_name("by_priority")
    t.orders.createOrReplaceTempView(view)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"""CREATE TABLE {table} USING parquet LOCATION '{scratch(spark, table)}' AS
            SELECT o_orderpriority, count(*) AS orders, min(o_orderkey) AS first_order
            FROM {view} GROUP BY o_orderpriority"""
    )
    return spark.table(table)


@query(
    "load_audit",
    f"""SELECT 'good' AS side, count(*) AS rows FROM ({TYPED}) WHERE bay_id IS NOT NULL
        UNION ALL SELECT 'malformed', count(*) FROM ({TYPED}) WHERE bay_id IS NULL""",
)
def load_audit(spark, t):
    """Rows of both sides of a load, counted while they are written."""
    good, bad = standardize_parking_bay(_bays(t), "load-1", LOADED_ON, persist=True)
    counts = []
    for side, rows in (("good", good), ("malformed", bad)):
        seen = Observation(f"{side}_{scratch_name('audit')}")
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(scratch(spark, side))
        counts.append((side, seen.get["rows"]))
    return spark.createDataFrame(counts, "side STRING, rows BIGINT")


@query(
    "lineage_edges",
    """SELECT 'orders' AS input, 'standardize' AS process, o.output, 'load-1' AS load_id, count(*) AS input_rows
       FROM orders, (VALUES ('interim.parking_bay'), ('malformed.parking_bay')) o(output) GROUP BY ALL
       UNION ALL SELECT 'customer', 'standardize', o.output, 'load-1', count(*)
       FROM customer, (VALUES ('interim.parking_bay'), ('malformed.parking_bay')) o(output) GROUP BY ALL""",
)
def lineage_edges(spark, t):
    """The edges of a load, read off the frames it wrote, each with the rows its input had."""
    log = scratch(spark, "lineage")
    named = t.orders.join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    named.createOrReplaceTempView(view := scratch_name("named"))
    for output, rows in (("interim.parking_bay", "o_orderkey % 3 > 0"), ("malformed.parking_bay", "o_orderkey % 3 = 0")):
        lineage.write(spark.table(view).where(rows), f"{scratch(spark, 'out')}/{output}", "standardize", "load-1", log)
    edges = spark.read.parquet(log).select(
        F.regexp_extract("input", r"(\w+)\.parquet$", 1).alias("input"), "process",
        F.regexp_extract("output", "[^/]+$", 0).alias("output"), "load_id",
    )
    sizes = load.audit_counts(t.orders, "orders", "load-1").unionByName(
        load.audit_counts(t.customer, "customer", "load-1")
    )
    rows = sizes.select(F.col("filename").alias("input"), F.col("count").alias("input_rows"))
    return edges.join(rows, "input")
