"""Time-binned monitoring, on event logs and metrics made from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightmere.operators import aggregates, observe
from brightmere.plans.registry import query

HOUR = "1 hour"
HOUR_BIN = "date_trunc('hour', ts)"


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


# Aggregates by bin over the events ------------------------------------------------------


@query(
    "p90_by_bin",
    f"""SELECT {HOUR_BIN} AS time_bin, event_type, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY ALL""",
)
def p90_by_bin(spark, t):
    found = aggregates.bin_aggregate(t.events, "ts", HOUR, ["event_type"], "quantile", "value", [0.9])
    return found.select("time_bin", "event_type", F.round(F.element_at("quantiles", 1), 6).alias("p90"))


@query(
    "p90_by_bin_sketch",
    f"SELECT {HOUR_BIN} AS time_bin, event_type, quantile_disc(value, 0.9) AS p90 FROM events GROUP BY ALL",
)
def p90_by_bin_sketch(spark, t):
    """The sketched form: one value of the bin, of a rank error below one in small bins."""
    found = aggregates.bin_aggregate(t.events, "ts", HOUR, ["event_type"], "quantile", "value", [0.9], exact=False)
    return found.select("time_bin", "event_type", F.element_at("quantiles", 1).alias("p90"))


@query(
    "quantiles_by_bin",
    f"""SELECT {HOUR_BIN} AS time_bin, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.3), 6) AS p30,
              round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY ALL""",
)
def quantiles_by_bin(spark, t):
    wanted = [0.1, 0.3, 0.5, 0.9]
    found = aggregates.bin_aggregate(t.events, "ts", HOUR, [], "quantile", "value", wanted)
    named = [F.round(F.element_at("quantiles", i + 1), 6).alias(f"p{int(q * 100)}") for i, q in enumerate(wanted)]
    return found.select("time_bin", *named)


@query(
    "sum_by_bin",
    f"""SELECT {HOUR_BIN} AS time_bin, event_type, sum(CAST(value AS DECIMAL(18,2)))::DOUBLE AS value FROM events GROUP BY ALL""",
)
def sum_by_bin(spark, t):
    exact = t.events.withColumn("amount", F.col("value").cast("decimal(18,2)"))
    found = aggregates.bin_aggregate(exact, "ts", HOUR, ["event_type"], "sum", "amount")
    return found.withColumn("value", F.col("value").cast("double"))


@query(
    "count_by_bin",
    "SELECT date_trunc('minute', ts) AS time_bin, event_type, count(*) AS value FROM events GROUP BY ALL",
)
def count_by_bin(spark, t):
    return aggregates.bin_aggregate(t.events, "ts", "1 minute", ["event_type"], "count")


@query(
    "dcount_by_bin",
    f"SELECT {HOUR_BIN} AS time_bin, event_type, count(DISTINCT user_id) AS value FROM events GROUP BY ALL",
)
def dcount_by_bin(spark, t):
    return aggregates.bin_aggregate(t.events, "ts", HOUR, ["event_type"], "dcount", "user_id")


@query(
    "dcount_by_bin_sketch",
    f"""SELECT {HOUR_BIN} AS time_bin, event_type, count(DISTINCT user_id) AS users, true AS close FROM events GROUP BY ALL""",
)
def dcount_by_bin_sketch(spark, t):
    """Sketched distinct counts, held against the exact ones."""

    def counted(exact):
        return aggregates.bin_aggregate(t.events, "ts", HOUR, ["event_type"], "dcount", "user_id", exact=exact)

    both = counted(True).join(counted(False).withColumnRenamed("value", "sketched"), ["time_bin", "event_type"])
    close = F.abs(F.col("value") - F.col("sketched")) <= F.col("value") * 0.3 + 1
    return both.select("time_bin", "event_type", F.col("value").alias("users"), close.alias("close"))


@query(
    "bin_delta",
    f"""SELECT {HOUR_BIN} AS time_bin, user_id, round(max(value) - min(value), 6) AS value FROM events GROUP BY ALL""",
)
def bin_delta(spark, t):
    return _rounded(aggregates.counter_delta(t.events, "ts", HOUR, ["user_id"], "value"), "value")


@query(
    "metric_ratio",
    """SELECT user_id, date_trunc('day', ts) AS day, round(max(value) FILTER (event_type = 'click') * 100
                / nullif(max(value) FILTER (event_type = 'view'), 0), 6) AS ratio
       FROM events GROUP BY ALL
       HAVING count(*) FILTER (event_type = 'click') > 0 AND count(*) FILTER (event_type = 'view') > 0""",
)
def metric_ratio(spark, t):
    """Clicks in percent of views, per user and day."""
    daily = t.events.withColumn("day", F.window("ts", "1 day").getField("start"))
    return _rounded(aggregates.metric_ratio(daily, "click", "view", ["user_id"], "day", "event_type"), "ratio")


# The saved queries ----------------------------------------------------------------------


def event_log(t):
    """An event log: orders as stages and as jobs, line items as tasks, events as progress.

    An order's number is its stage and job, its date the submission, its total the duration;
    orders in part have no namespace; finished ones are failed jobs; returned lines failed tasks.
    """
    seconds = F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")).cast("double") * 86400
    order = t.orders.select(
        F.col("o_orderdate").alias("time_generated"),
        F.lit("app-1").alias("app_id"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("metrics_namespace"),
        F.lit("main").alias("cluster"),
        F.concat(F.lit("site "), "o_orderpriority").alias("call_site"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        seconds.alias("begun"),
        (seconds + F.col("o_totalprice")).alias("ended"),
        F.when(F.col("o_orderstatus") == "F", "JobFailed").otherwise("JobSucceeded").alias("result"),
        F.col("o_custkey").alias("tasks"),
    )
    stage = {"stage_id": F.col("id"), "stage_name": F.col("name"), "stage_submission": F.col("begun")}
    ended = {**stage, "stage_completion": F.col("ended"), "stage_tasks": F.col("tasks")}
    days = F.datediff("l_shipdate", F.lit("1970-01-01").cast("date")).cast("double") * 86400
    parts = [
        order.withColumns({"event": F.lit("org.apache.spark.scheduler.SparkListenerStageSubmitted"), **stage}),
        order.withColumns({"event": F.lit("org.apache.spark.scheduler.SparkListenerStageCompleted"), **ended}),
        order.withColumns({"event": F.lit("SparkListenerJobStart"), "job_id": F.col("id"), "submission": F.col("begun")}),
        order.withColumns(
            {"event": F.lit("SparkListenerJobEnd"), "job_id": F.col("id"), "completion": F.col("ended"), "job_result": F.col("result")}
        ),
        t.lineitem.select(
            F.col("l_shipdate").alias("time_generated"),
            F.lit("SparkListenerTaskEnd").alias("event"),
            F.lit("app-1").alias("app_id"),
            F.col("l_orderkey").alias("stage_id"),
            F.col("l_linenumber").alias("task_id"),
            F.concat(F.lit("host-"), "l_suppkey").alias("task_host"),
            F.when(F.col("l_returnflag") == "R", "TaskKilled").otherwise("Success").alias("task_reason"),
            days.alias("task_launch"),
            (days + F.col("l_quantity")).alias("task_finish"),
            F.col("l_quantity").alias("run_time"),
            F.col("l_discount").alias("deserialize_time"),
            F.col("l_tax").alias("result_serialization_time"),
            (F.col("l_quantity") * 2).alias("fetch_wait_time"),
            F.col("l_extendedprice").alias("shuffle_write_time"),
            F.col("l_extendedprice").alias("shuffle_bytes_written"),
            F.col("l_partkey").alias("remote_bytes_read"),
            F.col("l_suppkey").alias("input_bytes_read"),
        ),
        t.events.select(
            F.col("ts").alias("time_generated"),
            F.lit("QueryProgressEvent").alias("event"),
            F.when(F.col("event_type") == "error", "Error").otherwise("Info").alias("level"),
            F.col("props").alias("message"),
            F.col("event_type").alias("progress_name"),
            F.col("value").alias("trigger_execution"),
            F.to_json(
                F.array(
                    F.struct(
                        F.get_json_object("props", "$.k").cast("double").alias("inputRowsPerSecond"),
                        F.col("value").alias("processedRowsPerSecond"),
                    )
                )
            ).alias("progress_sources"),
        ),
    ]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    present = set(whole.columns)
    return whole.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in StructType.fromDDL(observe.EVENTS).fields
        ]
    )


WIDE = "30 days"
WIDE_BIN = "time_bucket(INTERVAL 30 DAY, {0}, TIMESTAMP '1970-01-01')"
STAGES = """(SELECT o_orderkey, o_orderdate, epoch(o_orderdate) AS begun, epoch(o_orderdate) + o_totalprice AS ended, o_orderpriority,
                    o_custkey, o_orderstatus, 'main-' || CASE WHEN o_orderstatus = 'P' THEN 'app-1' ELSE o_orderstatus END AS app
             FROM orders)"""


@query(
    "obs_duration_quantiles",
    f"""WITH d AS (
          SELECT 'stage_latency' AS query, o_orderdate AS ts, app || ' ' || o_orderpriority AS slice, ended - begun AS v FROM {STAGES}
          UNION ALL SELECT 'job_latency', o_orderdate, app, ended - begun FROM {STAGES} WHERE o_orderstatus <> 'F')
        SELECT query, {WIDE_BIN.format('ts')} AS time_bin, slice, round(quantile_cont(v, 0.1), 6) AS p10,
               round(quantile_cont(v, 0.3), 6) AS p30, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.9), 6) AS p90
        FROM d GROUP BY ALL""",
)
def obs_duration_quantiles(spark, t):
    return _rounded(observe.duration_quantiles(event_log(t), WIDE), "p10", "p30", "p50", "p90")


MEASURES = {
    "task_shuffle_bytes_written": ("'SchuffleBytesWritten ' || app || ' '", "l_extendedprice"),
    "task_input_bytes_read": ("'InputBytesRead ' || app || ' '", "l_suppkey::DOUBLE"),
    "task_shuffle_read_time": ("'TaskShuffleReadTime ' || app || ' '", "l_quantity * 2"),
    "task_shuffle_write_time": ("'TaskShuffleWriteTime '", "l_extendedprice / 1000000"),
    "task_deserialization_time": ("'TaskDeserializationTime ' || app || ' '", "l_discount"),
    "task_result_serialization_time": ("'TaskResultSerializationTime ' || app || ' '", "l_tax"),
    "task_scheduler_delay": ("'SchedulerDelayTime ' || app || ' '", "epoch(l_shipdate) - begun"),
    "task_scheduler_run_time": ("'SchedulerDelayTime ' || app || ' '", "l_quantity"),
    "task_executor_compute_time": ("'ExecutorComputeTime ' || app || ' '", "l_quantity"),
    "task_shuffle_bytes_read": ("'SchuffleBytesRead ' || app || ' '", "l_partkey::DOUBLE"),
    "task_latency": ("app || '-'", "(epoch(l_shipdate) + l_quantity) - epoch(l_shipdate)"),
}


@query(
    "obs_task_p90",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS query, {WIDE_BIN.format('o_orderdate')} AS time_bin, {label} || o_orderpriority AS slice,
                   round(quantile_cont({value}, 0.9), 6) AS value
            FROM lineitem JOIN {STAGES} ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R' GROUP BY ALL"""
        for name, (label, value) in MEASURES.items()
    ),
)
def obs_task_p90(spark, t):
    return _rounded(observe.task_p90(event_log(t), WIDE), "value")


@query(
    "obs_event_counts",
    f"""SELECT query, {WIDE_BIN.format('ts')} AS time_bin, slice, count(*) AS value FROM (
          SELECT 'stage_throughput' AS query, o_orderdate AS ts, '# StagesCompleted ' || app || ' ' || o_orderpriority AS slice FROM {STAGES}
          UNION ALL SELECT CASE WHEN o_orderstatus = 'F' THEN 'job_errors' ELSE 'job_throughput' END, o_orderdate,
                           CASE WHEN o_orderstatus = 'F' THEN 'JobErrors site ' || o_orderpriority ELSE '#JobsCompleted ' || app END FROM {STAGES}
          UNION ALL SELECT CASE WHEN l_returnflag = 'R' THEN 'task_errors' ELSE 'task_throughput' END, o_orderdate,
                           CASE WHEN l_returnflag = 'R' THEN '#TaskErrors ' || o_orderpriority
                                ELSE '#TasksCompleted ' || app || ' ' || o_orderpriority END
                    FROM lineitem JOIN {STAGES} ON l_orderkey = o_orderkey
          UNION ALL SELECT 'stream_errors', ts, 'CountExceptions' || event_type FROM events WHERE event_type = 'error')
        GROUP BY ALL""",
)
def obs_event_counts(spark, t):
    return observe.event_counts(event_log(t), WIDE)


@query(
    "obs_tasks_per_stage",
    f"SELECT o_orderdate AS time_generated, app || ' ' || o_orderpriority AS slice, o_custkey AS tasks FROM {STAGES}",
)
def obs_tasks_per_stage(spark, t):
    return observe.tasks_per_stage(event_log(t))


@query(
    "obs_host_sum",
    f"""SELECT {WIDE_BIN.format('l_shipdate')} AS time_bin, 'host-' || l_suppkey AS task_host, sum(l_quantity) AS value
        FROM lineitem GROUP BY ALL""",
)
def obs_host_sum(spark, t):
    return observe.host_sum(event_log(t), WIDE)


@query(
    "obs_stream_p90",
    f"""SELECT query, {HOUR_BIN} AS time_bin, slice, round(quantile_cont(v, 0.9), 6) AS value FROM (
          SELECT 'stream_trigger_latency' AS query, ts, event_type || '-triggerexecution' AS slice, value AS v FROM events
          UNION ALL SELECT 'stream_processed_rows', ts, event_type || '-ProcRowsPerSecond', value FROM events
          UNION ALL SELECT 'stream_input_rows', ts, event_type || '-inputRowsPerSecond', CAST(json_extract(props, '$.k') AS DOUBLE) FROM events)
        GROUP BY ALL""",
)
def obs_stream_p90(spark, t):
    return _rounded(observe.stream_p90(event_log(t), HOUR), "value")


@query("obs_errors", "SELECT ts AS time_generated, props AS message FROM events WHERE event_type = 'error'")
def obs_errors(spark, t):
    return observe.errors(event_log(t))


# Which metric an event stands for: by its type, and by whether its value is below 5, 15 or 30.
METRIC_BOUNDS = (5, 15, 30)
METRIC_NAMES = {
    "click": ("executor.resultserializationtime", "executor.cpuTime", "executor.deserializetime", "executor.jvmGCTime"),
    "view": ("executor.RunTime",) * 4,
    "purchase": (
        "executor.memoryBytesSpilled", "executor.diskBytesSpilled",
        "executor.shuffleTotalBytesRead", "executor.shuffleRemoteBytesReadToDisk",
    ),
    "signup": ("shuffle-client.usedDirectMemory",) * 2 + ("shuffle-client.usedHeapMemory",) * 2,
    "error": ("threadpool.activeTasks",) * 2 + ("executor.filesystem.file.write_bytes", "executor.filesystem.file.read_bytes"),
}


def metric_log(t):
    """Executor metrics, sampled daily: users are executors, errors also come from the driver."""
    name = F.lit("")
    for kind, metrics in METRIC_NAMES.items():
        metric = F.lit(metrics[-1])
        for bound, below in zip(METRIC_BOUNDS[::-1], metrics[-2::-1]):
            metric = F.when(F.col("value") < bound, below).otherwise(metric)
        name = F.when(F.col("event_type") == kind, metric).otherwise(name)
    executor = F.when((F.col("event_type") == "error") & (F.col("value") >= 15), F.lit("driver")).otherwise(
        F.col("user_id").cast("string")
    )
    return t.events.select(
        F.window("ts", "1 day").getField("start").alias("time_generated"),
        F.concat_ws(".", F.lit("app-1"), executor, name).alias("name"),
        (F.col("value") * 100).alias("count"),
        "value",
    )


_NAME_CASES = " ".join(
    f"WHEN '{kind}' THEN CASE "
    + " ".join(f"WHEN value < {bound} THEN '{below}'" for bound, below in zip(METRIC_BOUNDS, metrics))
    + f" ELSE '{metrics[-1]}' END"
    for kind, metrics in METRIC_NAMES.items()
)
METRIC_SQL = f"""(SELECT *, date_trunc('day', ts) AS day, value * 100 AS cnt, CASE event_type {_NAME_CASES} END AS metric,
                         CASE WHEN event_type = 'error' AND value >= 15 THEN 'driver' ELSE CAST(user_id AS VARCHAR) END AS executor
                  FROM events)"""
WEEK = "7 days"
WEEK_BIN = "time_bucket(INTERVAL 7 DAY, day, TIMESTAMP '1970-01-01')"


@query(
    "obs_metric_ratio",
    f"""WITH at_once AS (
          SELECT executor, day, max(cnt) FILTER (metric = 'executor.RunTime') AS run,
                 max(cnt / 1000000) FILTER (metric = 'executor.cpuTime') AS cpu, max(cnt) FILTER (metric = 'executor.jvmGCTime') AS gc,
                 max(cnt) FILTER (metric = 'executor.resultserializationtime') AS ser,
                 max(cnt) FILTER (metric = 'executor.deserializetime') AS deser
          FROM {METRIC_SQL} GROUP BY ALL),
        shares AS (SELECT 'cpu_percent' AS query, day, executor, cpu * 100 / nullif(run, 0) AS v FROM at_once
                   UNION ALL SELECT 'jvm_gc_percent', day, executor, gc * 100 / nullif(run, 0) FROM at_once
                   UNION ALL SELECT 'serialize_percent', day, executor, ser * 100 / nullif(run, 0) FROM at_once
                   UNION ALL SELECT 'deserialize_percent', day, executor, deser * 100 / nullif(run, 0) FROM at_once)
        SELECT query, {WEEK_BIN} AS time_bin, 'app-1.' || executor AS slice, round(quantile_cont(v, 0.9), 6) AS value
        FROM shares WHERE v IS NOT NULL GROUP BY ALL""",
)
def obs_metric_ratio(spark, t):
    return _rounded(observe.ratio_p90(metric_log(t), WEEK), "value")


def _metric_union(table: dict, measure: str, aggregate: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS query, {WEEK_BIN} AS time_bin,
                   {"'executorid:' || executor" if number_only else "'app-1.' || executor"} AS slice,
                   round({aggregate.format(measure)}, 6) AS value
            FROM {METRIC_SQL} WHERE metric = '{metric}' GROUP BY ALL"""
        for name, (metric, number_only) in table.items()
    )


@query("obs_counter_delta", _metric_union(observe.COUNTERS, "cnt", "max({0}) - min({0})"))
def obs_counter_delta(spark, t):
    return _rounded(observe.counter_deltas(metric_log(t), WEEK), "value")


@query("obs_gauge_p90", _metric_union(observe.GAUGES, "value", "quantile_cont({0}, 0.9)"))
def obs_gauge_p90(spark, t):
    return _rounded(observe.gauge_p90(metric_log(t), WEEK), "value")


@query(
    "obs_executors",
    f"""SELECT {WEEK_BIN} AS time_bin, 'app-1' AS app, count(DISTINCT executor) AS value FROM {METRIC_SQL}
        WHERE metric LIKE 'executor.%' AND executor <> 'driver' GROUP BY ALL""",
)
def obs_executors(spark, t):
    return observe.running_executors(metric_log(t), WEEK)


@query(
    "obs_timeline",
    f"""SELECT {WIDE_BIN.format('o_orderdate')} AS time_bin, 'job_errors' AS query, 'JobErrors site ' || o_orderpriority AS slice, count(*) AS value
        FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL""",
)
def obs_timeline(spark, t):
    """One saved query, in time order."""
    return observe.timeline(observe.event_counts(event_log(t), WIDE, ["job_errors"]))
