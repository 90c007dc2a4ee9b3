"""Streams over the events: each runs to the end of its input and returns what it stored."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightmere.operators import aggregates, observe
from brightmere.plans import monitoring
from brightmere.plans.registry import SQL, query
from brightmere.session import scratch
from brightmere.streaming import streams

READING = StructType().add("deviceId", "long").add("temperature", "double").add("event_id", "long")


def _events(spark, t):
    """The events as a stream."""
    return streams.file_stream(spark, t.folder, t.events.schema, pathGlobFilter="events.parquet")


def _finished(query):
    query.awaitTermination()
    return query


def _stored(spark, stream, label):
    path, checkpoint = scratch(spark, label), scratch(spark, "checkpoint")
    _finished(streams.sink_files(stream, path, checkpoint))
    return spark.read.schema(stream.schema).parquet(path)


def _messages(spark, t):
    """Events as JSON messages. Errors arrive cut short; small views lack their temperature."""
    reading = F.to_json(
        F.struct(
            F.col("user_id").alias("deviceId"),
            F.when((F.col("event_type") != "view") | (F.col("value") >= 5), F.col("value")).alias("temperature"),
            "event_id",
        )
    )
    body = F.when(F.col("event_type") == "error", F.substring(reading, 1, 12)).otherwise(reading)
    return _events(spark, t).select("event_id", "ts", body.alias("body"))


READABLE = "event_type <> 'error' AND (event_type <> 'view' OR value >= 5)"


@query("stream_source", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_source(spark, t):
    return _stored(spark, _events(spark, t), "events")


@query("stream_sink", "SELECT event_id, user_id, event_type FROM events")
def stream_sink(spark, t):
    """A stream stopped and started again from its checkpoint stores each row once."""
    stream = _events(spark, t).select("event_id", "user_id", "event_type")
    path, checkpoint = scratch(spark, "sink"), scratch(spark, "checkpoint")
    for _ in range(2):
        _finished(streams.sink_files(stream, path, checkpoint))
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_filter", "SELECT event_id, value FROM events WHERE value > 27")
def stream_filter(spark, t):
    return _stored(spark, streams.filter_above(_events(spark, t), "VALUE").select("event_id", "value"), "warm")


def _devices(spark, t):
    good, _ = streams.decode(_messages(spark, t).select("body"), READING)
    return streams.device_filter(good, limit=8)


@query(
    "stream_device_filter",
    f"""SELECT user_id AS "deviceId", value AS temperature, event_id FROM events WHERE {READABLE} AND user_id < 8""",
)
def stream_device_filter(spark, t):
    return _stored(spark, _devices(spark, t).select(*READING.names), "devices")


def _split(spark, t):
    good, _ = streams.decode(_messages(spark, t).select("body"), READING)
    ok, out = scratch(spark, "ok"), scratch(spark, "out")
    _finished(
        streams.split_by_limit(good.select(*READING.names), "temperature", 100, ok, out, scratch(spark, "checkpoint"))
    )
    return streams.read_batches(spark, ok), streams.read_batches(spark, out)


@query(
    "stream_split_ok",
    f'SELECT user_id AS "deviceId", value AS temperature, event_id FROM events WHERE {READABLE} AND value < 100',
)
def stream_split_ok(spark, t):
    return _split(spark, t)[0]


@query(
    "stream_split_out",
    f'SELECT user_id AS "deviceId", value AS temperature, event_id FROM events WHERE {READABLE} AND value >= 100',
)
def stream_split_out(spark, t):
    return _split(spark, t)[1]


@query(
    "stream_split",
    f"SELECT value < 100 AS in_bounds, count(*) AS rows FROM events WHERE {READABLE} GROUP BY ALL",
)
def stream_split(spark, t):
    ok, out = _split(spark, t)
    sides = ok.select(F.lit(True).alias("in_bounds")).unionByName(out.select(F.lit(False).alias("in_bounds")))
    return sides.groupBy("in_bounds").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "stream_dead_letter",
    f"""SELECT event_id, event_type = 'error' AS broken FROM events WHERE NOT ({READABLE})""",
)
def stream_dead_letter(spark, t):
    """Broken and incomplete messages; the others are stored beside them."""
    good, dead = scratch(spark, "good"), scratch(spark, "dead")
    messages = _messages(spark, t).select(F.col("event_id").alias("message_id"), "body")
    _finished(streams.keep_decoded(messages, READING, good, dead, scratch(spark, "checkpoint")))
    broken = ~F.col("body").endswith("}")
    return streams.read_batches(spark, dead).select(F.col("message_id").alias("event_id"), broken.alias("broken"))


@query(
    "stream_telemetry",
    """SELECT CAST(user_id AS VARCHAR) AS device, event_id AS id, ts AS event_time,
              '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS shown
       FROM events""",
)
def stream_telemetry(spark, t):
    """Everything about a device's events under (device, time, id)."""
    rows = streams.telemetry_rows(_events(spark, t), "user_id", "ts", "event_id")
    path = scratch(spark, "telemetry")
    _finished(streams.sink_telemetry(rows, path, scratch(spark, "checkpoint")))
    whole = F.from_json("body", "event_id BIGINT, user_id BIGINT, event_type STRING")
    return spark.read.parquet(path).select("device", "id", "event_time", F.to_json(whole).alias("shown"))


@query(
    "stream_clamp_late",
    """SELECT event_id, greatest(ts, arrival - INTERVAL 5 SECOND) AS adjusted
       FROM (SELECT *, ts + CAST(json_extract(props, '$.k') AS INTEGER) * INTERVAL 1 SECOND AS arrival FROM events)""",
)
def stream_clamp_late(spark, t):
    """Events arrive as many seconds late as the number in their properties."""
    late = F.make_dt_interval(secs=F.get_json_object("props", "$.k").cast("decimal(18,6)"))
    arriving = _events(spark, t).withColumn("arrival", F.col("ts") + late)
    return _stored(spark, streams.clamp_late(arriving, "ts", "arrival").select("event_id", "adjusted"), "clamped")


@query("stream_dedupe", "SELECT event_id, ts, event_type FROM events")
def stream_dedupe(spark, t):
    """Every event arrives twice."""
    once = _events(spark, t).select("event_id", "ts", "event_type")
    twice = once.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    timed = twice.withColumn("at", F.col("ts").cast("timestamp"))
    unique = streams.dedupe(timed, ["event_id"], "at", "60 days")
    return _stored(spark, unique.select("event_id", "ts", "event_type"), "unique")


@query(
    "stream_bins",
    """SELECT * FROM (SELECT date_trunc('hour', ts) AS time_bin, event_type, count(*) AS value FROM events GROUP BY 1, 2)
       WHERE time_bin + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def stream_bins(spark, t):
    """Hourly counts of a stream: the bins that its watermark has closed."""
    timed = _events(spark, t).withColumn("at", F.col("ts").cast("timestamp"))
    counts = aggregates.bin_aggregate(timed, "at", "1 hour", ["event_type"], "count", late="10 minutes")
    return _stored(spark, counts, "bins").withColumn("time_bin", F.col("time_bin").cast("timestamp_ntz"))


@query(
    "stream_progress",
    """SELECT q AS query, 'events' AS progress_name, 1::BIGINT AS reports, (SELECT count(*) FROM events) AS input_rows
       FROM (VALUES ('stream_trigger_latency'), ('stream_processed_rows'), ('stream_input_rows')) v(q)""",
)
def stream_progress(spark, t):
    """Which rates the reports of a stream give, how many reports, and the rows they count."""
    log = streams.ProgressLog(spark, scratch(spark, "progress"))
    spark.streams.addListener(log)
    try:
        writer = _events(spark, t).writeStream.format("parquet").queryName("events").trigger(availableNow=True)
        writer = writer.option("checkpointLocation", scratch(spark, "checkpoint")).outputMode("append")
        log.wait(_finished(writer.start(scratch(spark, "events"))))
    finally:
        spark.streams.removeListener(log)
    reports = log.read().where(F.col("progress_name") == "events")
    rows = F.get_json_object("progress_sources", "$[0].numInputRows").cast("bigint")
    totals = reports.groupBy("progress_name").agg(
        F.count_if(rows > 0).alias("reports"), F.sum(rows).alias("input_rows")
    )
    names = observe.stream_p90(reports, "1 day").select("query").distinct()
    return names.withColumn("progress_name", F.lit("events")).join(totals, "progress_name")


def _event_stream(spark, t):
    """The event log of ``monitoring`` as a stream."""
    tables = {
        n: streams.file_stream(spark, t.folder, getattr(t, n).schema, pathGlobFilter=f"{n}.parquet") for n in ("orders", "lineitem", "events")
    }
    return monitoring.event_log(SimpleNamespace(**tables))


def _kept(spark, t, family):
    path = scratch(spark, family)
    _finished(observe.keep_counts(_event_stream(spark, t), family, path, scratch(spark, "checkpoint"), monitoring.WIDE))
    return observe.kept_counts(spark, family, path, monitoring.WIDE)


@query("stream_obs_event_counts", SQL["obs_event_counts"])
def stream_obs_event_counts(spark, t):
    """The counts of a streamed log are those of the stored one."""
    return _kept(spark, t, "event_counts")


@query("stream_obs_duration_quantiles", SQL["obs_duration_quantiles"])
def stream_obs_duration_quantiles(spark, t):
    """The exact quantiles of a streamed log are those of the stored one."""
    found = _kept(spark, t, "duration_quantiles")
    return found.withColumns({n: F.round(n, 6) for n in ("p10", "p30", "p50", "p90")})
