"""Saved monitoring queries over Spark event logs and executor metrics.

Event rows follow ``EVENTS`` and metric rows ``METRICS``. Each family answers its saved
queries in one pass over its input and returns them stacked, told apart by ``query``;
``only`` names the ones wanted. Times are binned by ``width``. Families that read one kind
of row (counters, gauges, stream rates, hosts, executors) also take a stream; durations and
counts of events, which tie ends to starts, take one by ``keep_counts`` and ``kept_counts``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brightmere.functions.scalars import first_present, json_number
from brightmere.operators.aggregates import bin_aggregate, bin_quantiles, text_contains
from brightmere.operators.quantiles import quantiles

EVENTS = """time_generated TIMESTAMP_NTZ, event STRING, app_id STRING, metrics_namespace STRING,
    cluster STRING, level STRING, message STRING, call_site STRING,
    stage_id BIGINT, stage_name STRING, stage_submission DOUBLE, stage_completion DOUBLE,
    stage_tasks BIGINT, job_id BIGINT, job_result STRING, submission DOUBLE, completion DOUBLE,
    task_id BIGINT, task_host STRING, task_reason STRING, task_launch DOUBLE, task_finish DOUBLE,
    deserialize_time DOUBLE, run_time DOUBLE, result_serialization_time DOUBLE,
    fetch_wait_time DOUBLE, shuffle_write_time DOUBLE, remote_bytes_read DOUBLE,
    shuffle_bytes_written DOUBLE, input_bytes_read DOUBLE,
    progress_name STRING, trigger_execution DOUBLE, progress_sources STRING"""
METRICS = "time_generated TIMESTAMP_NTZ, name STRING, count DOUBLE, value DOUBLE"

MINUTE = "1 minute"
# The keys that tie a task or a stage's end to the first start of its stage. Stage numbers
# repeat between applications; stage_keys=["stage_id"] mixes them.
STAGE_KEYS = ["app_id", "stage_id"]
JOB_KEYS = ["app_id", "job_id"]

# Fixed values below: event names, metric names and labels of the saved queries.
SUBMITTED, COMPLETED = "SparkListenerStageSubmitted", "SparkListenerStageCompleted"
JOB_START, JOB_END = "SparkListenerJobStart", "SparkListenerJobEnd"
TASK_END = "SparkListenerTaskEnd"
TASK_P90 = {
    "task_shuffle_bytes_written": ("SchuffleBytesWritten ", "shuffle_bytes_written"),
    "task_input_bytes_read": ("InputBytesRead ", "input_bytes_read"),
    "task_shuffle_read_time": ("TaskShuffleReadTime ", "fetch_wait_time"),
    "task_shuffle_write_time": ("TaskShuffleWriteTime ", "shuffle_write_time / 1000000"),
    "task_deserialization_time": ("TaskDeserializationTime ", "deserialize_time"),
    "task_result_serialization_time": ("TaskResultSerializationTime ", "result_serialization_time"),
    "task_scheduler_delay": ("SchedulerDelayTime ", "task_launch - start_stage_submission"),
    "task_scheduler_run_time": ("SchedulerDelayTime ", "run_time"),
    "task_executor_compute_time": ("ExecutorComputeTime ", "run_time"),
    "task_shuffle_bytes_read": ("SchuffleBytesRead ", "remote_bytes_read"),
    "task_latency": ("", "task_finish - task_launch"),
}
# These are tied to the end of the stage instead of its start.
FROM_COMPLETED = {"task_shuffle_write_time"}
TASK_FIELDS = [
    "task_launch", "task_finish", "run_time", "deserialize_time", "result_serialization_time", "fetch_wait_time",
    "shuffle_write_time", "remote_bytes_read", "shuffle_bytes_written", "input_bytes_read",
]
RUN_TIME = "executor.RunTime"
RATIOS = {
    "serialize_percent": ("executor.resultserializationtime", 1),
    "cpu_percent": ("executor.cpuTime", 1_000_000),
    "deserialize_percent": ("executor.deserializetime", 1),
    "jvm_gc_percent": ("executor.jvmGCTime", 1),
}
# (part of the metric name, whether the slice is the executor number alone)
COUNTERS = {
    "shuffle_bytes_read": ("executor.shuffleTotalBytesRead", False),
    "shuffle_disk_spilled_per_executor": ("executor.diskBytesSpilled", True),
    "shuffle_memory_spilled_per_executor": ("executor.memoryBytesSpilled", False),
    "shuffle_read_to_disk_per_executor": ("executor.shuffleRemoteBytesReadToDisk", True),
    "disk_bytes_spilled": ("executor.diskBytesSpilled", False),
    "shuffle_bytes_read_to_disk": ("executor.shuffleRemoteBytesReadToDisk", False),
}
GAUGES = {
    "shuffle_heap_memory": ("shuffle-client.usedHeapMemory", False),
    "file_bytes_read": ("executor.filesystem.file.read_bytes", False),
    "active_tasks": ("threadpool.activeTasks", False),
    "file_bytes_written": ("executor.filesystem.file.write_bytes", False),
    "shuffle_client_memory": ("shuffle-client.usedDirectMemory", True),
    "shuffle_client_direct_memory": ("shuffle-client.usedDirectMemory", False),
}
STREAM_P90 = {
    "stream_trigger_latency": ("queryprogressevent", "-triggerexecution", None),
    "stream_processed_rows": ("progress", "-ProcRowsPerSecond", "$[0].processedRowsPerSecond"),
    "stream_input_rows": ("progress", "-inputRowsPerSecond", "$[0].inputRowsPerSecond"),
}


@dataclass(frozen=True)
class _Slice:
    """A query's name and slice for the rows its condition holds for."""

    query: str
    slice: Column
    value: Column
    when: Column | None = None

    def entry(self) -> Column:
        made = F.struct(
            F.lit(self.query).alias("query"), self.slice.alias("slice"), self.value.alias("value")
        )
        return made if self.when is None else F.when(self.when, made)


def _stack(df: DataFrame, ts: str, slices: list[_Slice]) -> DataFrame:
    """(time_generated, query, slice, value): one row per input row and query that wants it."""
    wanted = F.array_compact(F.array(*[s.entry() for s in slices]))
    return df.select(F.col(ts).alias("time_generated"), F.inline(wanted))


def _chosen(names, only: list[str] | None) -> list[str]:
    unknown = set(only or ()) - set(names)
    if unknown:
        raise KeyError(f"no such queries: {sorted(unknown)}")
    return [n for n in names if only is None or n in only]


def _of(events: DataFrame, kind: str) -> DataFrame:
    return events.where(text_contains(F.col("event"), kind))


def _text(*parts: Column | str) -> Column:
    """Parts joined to one text; a missing part is empty."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


# What a start lends to the rows tied to it.
LENT = ["cluster", "stage_name", "stage_submission", "submission", "call_site"]
NO_KEY = ""


def _key(kind: str, keys: list[str]) -> Column:
    """A kind of start and the values that tie rows to it, NULL where one of them is missing."""
    return F.concat(F.lit(kind), *[F.concat(F.lit("\n"), F.length(F.col(k).cast("string")), F.lit(" "), F.col(k)) for k in keys])


def _lent(events: DataFrame) -> Column:
    """What a start lends, least for the first one (one without a time comes last)."""
    tag = first_present(events, "metrics_namespace", "app_id").alias("apptag")
    return F.struct(F.col("time_generated").isNull().alias("untimed"), "time_generated", tag, *LENT)


def _begin(events: DataFrame, key: Column) -> Column:
    """An entry of the log that other ones are tied to by ``key``."""
    nothing = F.lit(None).cast("string")
    return F.struct(
        key.alias("key"), nothing.alias("query"), nothing.alias("label"),
        F.lit(None).cast("double").alias("value"), _lent(events).alias("start"),
    )


def _end(events: DataFrame, key: Column | None, query: Column | str, label: str | None = None, value: Column | None = None) -> Column:
    """An entry that counts for ``query``, tied to the start of its ``key``; without one it has
    its own time."""
    return F.struct(
        (F.lit(NO_KEY) if key is None else key).alias("key"),
        (F.lit(query) if isinstance(query, str) else query).alias("query"),
        (F.lit(None) if label is None else F.col(label)).cast("string").alias("label"),
        (F.lit(None) if value is None else value).cast("double").alias("value"),
        F.when(F.lit(False), _lent(events)).alias("start"),
    )


def _told(events: DataFrame, entries: dict[str, list[Column]], width: str, others: Column | None = None) -> DataFrame:
    """The entries that rows of the log tell, see ``_added``.

    ``entries`` has the entries of a kind of event, ``others`` an array of further ones. The log is
    read once, and only what the entries name of it.
    """
    told = F.lit(None)
    for kind, made in reversed(entries.items()):
        told = F.when(text_contains(F.col("event"), kind), F.array(*made)).otherwise(told)
    if others is not None:
        told = F.concat(F.coalesce(told, F.array()), F.coalesce(others, F.array())) if entries else others
    rows = events.select("time_generated", F.explode(told).alias("e")).where("e.key IS NOT NULL")
    # No key is NULL from here on; entries of one key need no time.
    key = F.coalesce("e.key", F.lit(NO_KEY))
    epoch = F.lit("1970-01-01").cast(events.schema["time_generated"].dataType)
    own = F.coalesce(F.when(key == NO_KEY, F.col("time_generated")), epoch)
    at = F.window(own, width).getField("start").alias("at")
    return rows.select(key.alias("key"), "e.query", "e.label", "e.value", at, "e.start")


def _added(entries: DataFrame) -> DataFrame:
    """(key, query, label, value, at, start, n): equal entries counted, starts among them (n is 0).

    The reading tasks count. Such counts of parts of a log add up to those of the whole. Starts are
    keys here, of which ``_met`` takes the first: a least one taken in this place would have Spark
    sort all entries, ends too.
    """
    return entries.groupBy("key", "query", "label", "value", "at", "start").agg(F.count("query").alias("n"))


def _met(counted: DataFrame, width: str) -> DataFrame:
    """(query, time_bin, start, label, value, n): counted entries with the first start of their key.

    Only counts and starts travel and meet, so a start never multiplies what is tied to it.
    """
    # Conditions on the count alone, which is not known before the shuffle: both sides read the same one.
    starts = counted.where("n = 0").groupBy("key").agg(F.min("start").alias("start"))
    ends = counted.where("n > 0").drop("start")
    tied = ends.join(starts, "key", "left").where(F.col("start").isNotNull() | (F.col("key") == NO_KEY))
    time = F.when(F.col("start").isNull(), F.col("at")).otherwise(F.col("start.time_generated"))
    return tied.withColumn("time", time).select(
        "query", F.window("time", width).getField("start").alias("time_bin"), "start", "label", "value", "n"
    )


def _app(sep: str = "-") -> list[Column | str]:
    return [F.col("start.cluster"), sep, F.col("start.apptag")]


def _p90(
    df: DataFrame, ts: str, width: str, keys: list[str], measures: dict[str, Column], labels: dict[str, Column],
    exact: bool,
) -> DataFrame:
    """The 90th percentile of each measure per bin and keys, stacked as (query, time_bin,
    slice, value). All measures are columns of one grouping; the labels are made of its
    keys afterwards."""
    measured = df.select(ts, *keys, *[m.cast("double").alias(n) for n, m in measures.items()])
    return _stacked(bin_quantiles(measured, ts, width, keys, list(measures), [0.9], exact), labels)


def _stacked(found: DataFrame, labels: dict[str, Column]) -> DataFrame:
    """(query, time_bin, slice, value) of the quantiles found for each measure, as its query."""
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("query"),
                "time_bin",
                label.alias("slice"),
                F.element_at(n, 1).alias("value"),
            )
            for n, label in labels.items()
        ]
    )
    return found.select(F.inline(rows)).where(F.col("value").isNotNull())


def duration_quantiles(
    events: DataFrame,
    width: str = MINUTE,
    only: list[str] | None = None,
    exact: bool = True,
    stage_keys: list[str] = STAGE_KEYS,
) -> DataFrame:
    """Quantiles 10, 30, 50 and 90 of stage and job durations. For a stream see ``keep_counts``."""
    return _durations(_met(_added(_duration_entries(events, width, only, stage_keys)), width), exact)


def _duration_entries(events: DataFrame, width: str, only: list[str] | None, stage_keys: list[str]) -> DataFrame:
    chosen = _chosen(["stage_latency", "job_latency"], only)
    entries = {}
    if "stage_latency" in chosen:
        stage = _key("stage", stage_keys)
        took = F.col("stage_completion") - F.col("stage_submission")
        entries |= {SUBMITTED: [_begin(events, stage)], COMPLETED: [_end(events, stage, "stage_latency", "stage_name", took)]}
    if "job_latency" in chosen:
        job = _key("job", JOB_KEYS)
        done = F.when(text_contains(F.col("job_result"), "JobSucceeded"), job)
        entries |= {JOB_START: [_begin(events, job)], JOB_END: [_end(events, done, "job_latency", None, F.col("completion"))]}
    return _told(events, entries, width)


def _durations(tied: DataFrame, exact: bool = True) -> DataFrame:
    took = F.when(F.col("query") == "job_latency", F.col("value") - F.col("start.submission")).otherwise(F.col("value"))
    rows = tied.select(
        "query", "time_bin", F.col("start.cluster").alias("cluster"), F.col("start.apptag").alias("apptag"),
        F.col("label").alias("stage"), took.alias("took"), "n",
    )
    keys = ["query", "time_bin", "cluster", "apptag", "stage"]
    qs = [0.1, 0.3, 0.5, 0.9]
    found = quantiles(rows, keys, ["took"], qs, weight="n") if exact else quantiles(_repeated(rows), keys, ["took"], qs, False)
    label = _text(F.col("cluster"), "-", F.col("apptag"), F.when(F.col("stage").isNotNull(), F.concat(F.lit(" "), "stage")))
    named = [F.element_at("took", i + 1).alias(f"p{p}") for i, p in enumerate((10, 30, 50, 90))]
    return found.where(F.col("took").isNotNull()).select("query", "time_bin", label.alias("slice"), *named)


def _repeated(rows: DataFrame) -> DataFrame:
    """Each row as often as its ``n`` says."""
    return rows.withColumn("n", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))


def task_p90(
    events: DataFrame,
    width: str = MINUTE,
    only: list[str] | None = None,
    exact: bool = True,
    stage_keys: list[str] = STAGE_KEYS,
) -> DataFrame:
    """The 90th percentile of task measures per stage.

    Starts and ends of a stage are reduced to one row, which the stage's tasks meet once.
    """
    chosen = _chosen(TASK_P90, only)
    is_end, is_start = (text_contains(F.col("event"), kind) for kind in (COMPLETED, SUBMITTED))
    lent = _lent(events)
    stages = events.where(is_start | is_end).groupBy(*stage_keys).agg(
        F.min(F.when(is_start, lent)).alias("start"), F.min(F.when(is_end, lent)).alias("end")
    )
    tasks = events.where(text_contains(F.col("event"), TASK_END) & text_contains(F.col("task_reason"), "Success"))
    tied = tasks.select(*stage_keys, *TASK_FIELDS).join(stages, stage_keys)
    tied = tied.withColumn("start_stage_submission", F.col("start.stage_submission"))
    sides = []
    for side, of_end in (("start", False), ("end", True)):
        names = [n for n in chosen if (n in FROM_COMPLETED) == of_end]
        if names:
            given = {"cluster": f"{side}.cluster", "apptag": f"{side}.apptag"} if not of_end else {}
            keys = [F.col(given[k]).alias(k) if k in given else F.lit(None).cast("string").alias(k) for k in ("cluster", "apptag")]
            measures = [
                (F.expr(TASK_P90[n][1]) if n in names else F.lit(None)).cast("double").alias(n) for n in chosen
            ]
            made = F.struct(
                F.lit(side).alias("side"), F.col(f"{side}.time_generated").alias("at"), *keys,
                F.col(f"{side}.stage_name").alias("stage_name"), *measures,
            )
            sides.append(F.when(F.col(side).isNotNull(), made))
    rows = tied.select(F.inline(F.array(*sides))).where("side IS NOT NULL")
    found = bin_quantiles(rows, "at", width, ["side", "cluster", "apptag", "stage_name"], chosen, [0.9], exact)
    stage = F.col("stage_name")
    app = [F.col("cluster"), "-", F.col("apptag")]
    labels = {
        n: _text(TASK_P90[n][0], stage)
        if n in FROM_COMPLETED
        else _text(TASK_P90[n][0], *app, "-" if n == "task_latency" else " ", stage)
        for n in chosen
    }
    return _stacked(found, labels)


COUNTS = ["stage_throughput", "job_throughput", "job_errors", "task_errors", "stream_errors", "task_throughput"]


def event_counts(
    events: DataFrame,
    width: str = MINUTE,
    only: list[str] | None = None,
    stage_keys: list[str] = STAGE_KEYS,
) -> DataFrame:
    """Numbers of finished and failed stages, jobs, tasks and stream errors. For a stream see
    ``keep_counts``."""
    return _numbers(_met(_added(_event_entries(events, width, only, stage_keys)), width))


def _event_entries(events: DataFrame, width: str, only: list[str] | None, stage_keys: list[str]) -> DataFrame:
    chosen = _chosen(COUNTS, only)
    begun, ended, job = _key("stage", stage_keys), _key("stage end", stage_keys), _key("job", JOB_KEYS)
    success = F.coalesce(text_contains(F.col("task_reason"), "Success"), F.lit(False))
    succeeded = F.coalesce(text_contains(F.col("job_result"), "JobSucceeded"), F.lit(False))
    # What is not chosen has no key.
    task = F.when(success, _if("task_throughput", chosen)).otherwise(_if("task_errors", chosen))
    done = F.when(succeeded, _if("job_throughput", chosen)).otherwise(_if("job_errors", chosen))
    entries = {
        TASK_END: [_end(events, F.when(task.isNotNull(), F.when(success, begun).otherwise(ended)), task)],
        SUBMITTED: [_begin(events, begun)],
        COMPLETED: [
            _begin(events, ended),
            _end(events, F.when(_if("stage_throughput", chosen).isNotNull(), begun), "stage_throughput", "stage_name"),
        ],
        JOB_START: [_begin(events, job)],
        JOB_END: [_end(events, F.when(done.isNotNull(), job), done)],
    }
    # Starts that nothing chosen is tied to stay out.
    for kind, names in ((SUBMITTED, ("stage_throughput", "task_throughput")), (JOB_START, ("job_throughput", "job_errors"))):
        if not set(names) & set(chosen):
            del entries[kind]
    if "task_errors" not in chosen:
        del entries[COMPLETED][0]
    errors = None
    if "stream_errors" in chosen:
        is_error = text_contains(F.col("level"), "Error")
        errors = F.when(is_error, F.array(_end(events, None, "stream_errors", "progress_name")))
    return _told(events, entries, width, errors)


def _numbers(tied: DataFrame) -> DataFrame:
    stage = F.col("start.stage_name")
    slices = {
        "stage_throughput": _text("# StagesCompleted ", *_app(), " ", F.col("label")),
        "task_throughput": _text("#TasksCompleted ", *_app(), " ", stage),
        "job_throughput": _text("#JobsCompleted ", *_app()),
        "job_errors": _text("JobErrors ", F.col("start.call_site")),
        "task_errors": _text("#TaskErrors ", stage),
        "stream_errors": _text("CountExceptions", F.col("label")),
    }
    slice = F.lit(None).cast("string")
    for name in COUNTS:
        slice = F.when(F.col("query") == name, slices[name]).otherwise(slice)
    return tied.groupBy("query", "time_bin", slice.alias("slice")).agg(F.sum("n").alias("value"))


# Families that tie ends to starts, on streams: their entries, and what is made of the counts of them.
TIED = {"duration_quantiles": (_duration_entries, _durations), "event_counts": (_event_entries, _numbers)}


def keep_counts(
    stream: DataFrame,
    family: str,
    path: str,
    checkpoint: str,
    width: str = MINUTE,
    only: list[str] | None = None,
    stage_keys: list[str] = STAGE_KEYS,
    **trigger,
) -> StreamingQuery:
    """Count a stream of events for a family of ``TIED``, batch by batch, to a folder.

    A batch stores its equal entries counted and its starts. A batch that is replayed after
    a failure replaces what it wrote. Starts and ends may come in any order and as late as they
    will; none is dropped, and none waits in the memory of an executor.
    """
    told, _ = TIED[family]

    def write(batch: DataFrame, number: int) -> None:
        _added(batch).write.mode("overwrite").parquet(f"{path}/_batch={number}")

    # Entries are made on the stream, as a batch holds every column of what it is given.
    return (
        told(stream, width, only, stage_keys).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def kept_counts(
    spark: SparkSession,
    family: str,
    path: str,
    width: str = MINUTE,
    only: list[str] | None = None,
    stage_keys: list[str] = STAGE_KEYS,
) -> DataFrame:
    """The rows of a family for all that ``keep_counts`` has stored with the same settings: those
    of the batch form over the same events."""
    told, made = TIED[family]
    layout = _added(told(spark.createDataFrame([], EVENTS), width, only, stage_keys)).schema
    return made(_met(spark.read.schema(layout).parquet(path), width))


def _if(name: str, chosen: list[str]) -> Column:
    """The name of a chosen query, else NULL."""
    return F.lit(name if name in chosen else None).cast("string")


def tasks_per_stage(events: DataFrame, stage_keys: list[str] = STAGE_KEYS) -> DataFrame:
    """(time_generated, slice, tasks) per finished stage."""
    is_start = text_contains(F.col("event"), SUBMITTED)
    starts = events.where(is_start).groupBy(*stage_keys).agg(F.min(_lent(events)).alias("start"))
    ends = events.where(text_contains(F.col("event"), COMPLETED)).select(*stage_keys, "stage_name", "stage_tasks")
    return ends.join(starts, stage_keys).select(
        F.col("start.time_generated").alias("time_generated"),
        _text(*_app(), " ", F.col("stage_name")).alias("slice"),
        F.col("stage_tasks").alias("tasks"),
    )


def _executor(number_only: bool = False) -> Column:
    parts = F.split("name", r"\.")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return _text("executorid:", second) if number_only else _text(first, ".", second)


def _named(part: str) -> Column:
    return text_contains(F.col("name"), part)


def ratio_p90(
    metrics: DataFrame, width: str = MINUTE, only: list[str] | None = None, exact: bool = True
) -> DataFrame:
    """The 90th percentile of time shares (in percent of the run time) per executor.

    All samples of an executor and instant meet in one grouping.
    """
    chosen = _chosen(RATIOS, only)
    parts = [RUN_TIME, *[RATIOS[n][0] for n in chosen]]
    wanted = _named(parts[0])
    for part in parts[1:]:
        wanted = wanted | _named(part)
    at_once = metrics.where(wanted).groupBy(_executor().alias("executor"), "time_generated").agg(
        F.max(F.when(_named(RUN_TIME), F.col("count"))).alias("_run"),
        *[F.max(F.when(_named(RATIOS[n][0]), F.col("count") / RATIOS[n][1])).alias(n) for n in chosen],
    )
    shares = {n: F.try_divide(F.col(n) * 100, F.col("_run")) for n in chosen}
    labels = {n: F.col("executor") for n in chosen}
    ran = at_once.where(F.col("_run").isNotNull())
    return _p90(ran, "time_generated", width, ["executor"], shares, labels, exact)


def _metric_slices(table: dict, chosen: list[str], value: str) -> list[_Slice]:
    return [_Slice(n, _executor(table[n][1]), F.col(value), _named(table[n][0])) for n in chosen]


def counter_deltas(metrics: DataFrame, width: str = MINUTE, only: list[str] | None = None) -> DataFrame:
    """Growth of counters per executor and bin."""
    slices = _metric_slices(COUNTERS, _chosen(COUNTERS, only), "count")
    stacked = _stack(metrics, "time_generated", slices)
    return bin_aggregate(stacked, "time_generated", width, ["query", "slice"], "delta", "value")


def gauge_p90(
    metrics: DataFrame, width: str = MINUTE, only: list[str] | None = None, exact: bool = True
) -> DataFrame:
    """The 90th percentile of gauges per executor."""
    slices = _metric_slices(GAUGES, _chosen(GAUGES, only), "value")
    stacked = _stack(metrics, "time_generated", slices)
    found = bin_quantiles(stacked, "time_generated", width, ["query", "slice"], ["value"], [0.9], exact)
    return found.withColumn("value", F.element_at("value", 1)).where(F.col("value").isNotNull())


def host_sum(events: DataFrame, width: str = MINUTE) -> DataFrame:
    """Total task time per host."""
    tasks = _of(events, "taskend").withColumn("took", F.col("task_finish") - F.col("task_launch"))
    return bin_aggregate(tasks, "time_generated", width, ["task_host"], "sum", "took")


def running_executors(metrics: DataFrame, width: str = MINUTE, exact: bool = True) -> DataFrame:
    """Number of executors per application."""
    parts = F.split("name", r"\.")
    seen = metrics.where(_named("executor") & ~_named("driver")).select(
        "time_generated",
        F.get(parts, F.lit(0)).alias("app"),
        F.get(parts, F.lit(1)).alias("executor"),
    )
    return bin_aggregate(seen, "time_generated", width, ["app"], "dcount", "executor", exact=exact)


def stream_p90(
    events: DataFrame, width: str = MINUTE, only: list[str] | None = None, exact: bool = True
) -> DataFrame:
    """The 90th percentile of trigger time and row rates per stream."""
    chosen = _chosen(STREAM_P90, only)
    measures, labels = {}, {}
    for n in chosen:
        kind, label, path = STREAM_P90[n]
        value = F.col("trigger_execution") if path is None else json_number(F.col("progress_sources"), path)
        measures[n] = F.when(text_contains(F.col("event"), kind), value)
        labels[n] = _text(F.col("progress_name"), label)
    progress = _of(events, "progress")
    return _p90(progress, "time_generated", width, ["progress_name"], measures, labels, exact)


def errors(events: DataFrame) -> DataFrame:
    """(time_generated, message) of logged errors."""
    return events.where(text_contains(F.col("level"), "Error")).select("time_generated", "message")


def timeline(df: DataFrame, ts: str = "time_bin") -> DataFrame:
    """A result in time order, rows without a time last."""
    return df.orderBy(F.col(ts).asc_nulls_last())
