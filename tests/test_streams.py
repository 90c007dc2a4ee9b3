"""Streams from files, with the boundary values of the filters and restarts."""

import datetime as dt
import json

import pytest
from conftest import values
from pyspark.sql import functions as F

from brightmere.operators import aggregates
from brightmere.schemas import get_schema
from brightmere.session import scratch
from brightmere.streaming import streams


@pytest.fixture
def landing(spark, tmp_path):
    """A folder of text messages; every call lands one more file."""
    folder = tmp_path / "landing"
    folder.mkdir()
    state = {"n": 0}

    def land(*messages):
        state["n"] += 1
        lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
        (folder / f"{state['n']}.txt").write_text("\n".join(lines) + "\n")
        return streams.file_stream(spark, str(folder), "value STRING", "text").select(F.col("value").alias("body"))

    return land


def run(query):
    query.awaitTermination()
    return query


def local(path):
    return path.removeprefix("file:")


def event(device, temperature, **more):
    return {"deviceId": device, "temperature": temperature, "time": "t", **more}


def test_warm_readings(spark, landing):
    stream = landing(*[{"messageId": i, "deviceId": "d", "temperature": t, "humidity": 1.0}
                       for i, t in enumerate([30.0, 27, 27.1, 26.9, 26.999999999999999])])
    good, _ = streams.decode(stream, get_schema("device_reading"))
    path = scratch(spark, "warm")
    run(streams.sink_files(streams.filter_above(good, "TEMPERATURE").drop("body"), path, scratch(spark, "c")))
    assert values(spark.read.parquet(path).select("messageId")) == [(0,), (2,)]


@pytest.mark.parametrize("device, passes", [(999, True), (1000, False)])
def test_device_limit(rows, device, passes):
    assert streams.device_filter(rows([(device,)], "deviceId INT")).count() == passes


MESSAGES = [event(1, 99), event(2, 100), event(3, None), {"deviceId": 4, "time": "t"}, "{broken", "7", event("x", 5), event(1000, 5)]


def test_decode(spark, landing):
    good, dead = scratch(spark, "good"), scratch(spark, "dead")
    query = run(streams.keep_decoded(landing(*MESSAGES), get_schema("device_event"), good, dead, scratch(spark, "c")))
    assert values(streams.read_batches(spark, good).select("deviceId", "temperature")) == [(1, 99), (1000, 5), (2, 100)]
    assert streams.read_batches(spark, dead).count() == 5
    counted = [p.observedMetrics["decode"] for p in query.recentProgress if p.observedMetrics]
    assert sum(c.messages for c in counted) == 8 and sum(c.dead for c in counted) == 5


def test_decode_compat(spark, landing):
    """Missing whole numbers are zero, only unreadable messages are dead."""
    good, dead = scratch(spark, "good"), scratch(spark, "dead")
    run(streams.keep_decoded(landing(*MESSAGES), get_schema("device_event"), good, dead, scratch(spark, "c"), compat=True))
    assert values(streams.read_batches(spark, good).select("deviceId", "temperature")) == [
        (1, 99), (1000, 5), (2, 100), (3, 0), (4, 0)]
    assert streams.read_batches(spark, dead).count() == 3


def test_split_and_restart(spark, landing):
    ok, out, checkpoint = scratch(spark, "ok"), scratch(spark, "out"), scratch(spark, "c")

    def split(stream):
        good, _ = streams.decode(stream, get_schema("device_event"))
        run(streams.split_by_limit(good.drop("body"), "temperature", streams.BOUND, ok, out, checkpoint))

    split(landing(event(1, 99), event(2, 100)))
    split(landing(event(3, 5)))
    # Nothing new: nothing is added.
    stream = landing()
    split(stream)
    assert values(streams.read_batches(spark, ok).select("deviceId")) == [(1,), (3,)]
    assert values(streams.read_batches(spark, out).select("deviceId")) == [(2,)]


def test_replayed_batch_replaces_itself(spark, landing):
    """The state of a crash after the writes, before the batch was marked as done."""
    import shutil

    ok, out, checkpoint = scratch(spark, "ok"), scratch(spark, "out"), scratch(spark, "c")
    stream = streams.decode(landing(event(1, 99), event(2, 100)), get_schema("device_event"))[0].drop("body")
    run(streams.split_by_limit(stream, "temperature", 100, ok, out, checkpoint))
    before = scratch(spark, "c")
    shutil.copytree(local(checkpoint), local(before), ignore=shutil.ignore_patterns("commits"))
    run(streams.split_by_limit(stream, "temperature", 100, ok, out, before))
    assert streams.read_batches(spark, ok).count() == 1 and streams.read_batches(spark, out).count() == 1


def test_clamp(rows):
    t = dt.datetime(2024, 1, 1, 12)
    second = dt.timedelta(seconds=1)
    data = [("late", t - 9 * second, t), ("edge", t - 5 * second, t), ("early", t + second, t)]
    df = streams.clamp_late(rows(data, "n STRING, event TIMESTAMP_NTZ, arrival TIMESTAMP_NTZ"), "event", "arrival")
    assert values(df.select("n", "adjusted")) == [("early", t + second), ("edge", t - 5 * second), ("late", t - 5 * second)]


def test_dedupe_over_restart(spark, landing):
    path, checkpoint = scratch(spark, "unique"), scratch(spark, "c")

    def keep(stream):
        timed = stream.withColumn("at", F.lit("2024-01-01").cast("timestamp"))
        run(streams.sink_files(streams.dedupe(timed, ["body"], "at", "1 hour"), path, checkpoint))

    keep(landing("a", "b", "a"))
    keep(landing("b", "c"))
    assert values(spark.read.parquet(path).select("body")) == [("a",), ("b",), ("c",)]


def test_bins_of_a_stream(spark, landing):
    messages = [{"at": f"2024-01-01T{h:02d}:{m:02d}:00Z"} for h, m in ((1, 5), (1, 50), (2, 1), (9, 0))]
    stream = landing(*messages).select(F.get_json_object("body", "$.at").cast("timestamp").alias("at"))
    path = scratch(spark, "bins")
    counts = aggregates.bin_aggregate(stream, "at", "1 hour", [], "count", late="10 minutes")
    run(streams.sink_files(counts, path, scratch(spark, "c")))
    found = spark.read.parquet(path).select(F.hour("time_bin"), "value")
    assert values(found) == [(1, 2), (2, 1)]


def test_streamed_quantiles_are_sketched(spark, landing):
    stream = landing({"at": "2024-01-01T01:05:00Z", "v": 5}, {"at": "2024-01-01T09:00:00Z", "v": 1})
    timed = stream.select(F.get_json_object("body", "$.at").cast("timestamp").alias("at"),
                          F.get_json_object("body", "$.v").cast("double").alias("v"))
    path = scratch(spark, "bins")
    found = aggregates.bin_aggregate(timed, "at", "1 hour", [], "quantile", "v", [0.5], late="10 minutes")
    run(streams.sink_files(found, path, scratch(spark, "c")))
    assert [r.quantiles for r in spark.read.parquet(path).collect()] == [[5.0]]


def test_telemetry_keeps_everything(spark, landing):
    stream = landing({"d": "x", "n": 1}, {"d": "y", "n": 2}).select(
        F.get_json_object("body", "$.d").alias("d"), F.get_json_object("body", "$.n").alias("n"), F.lit(1).alias("t")
    )
    path = scratch(spark, "telemetry")
    run(streams.sink_telemetry(streams.telemetry_rows(stream, "d", "t", "n", buckets=4), path, scratch(spark, "c")))
    assert values(spark.read.parquet(path).select("device", "body")) == [
        ("x", '{"d":"x","n":"1","t":1}'), ("y", '{"d":"y","n":"2","t":1}')]


def test_load_mix(spark):
    """Half the devices are filtered out, a fifth of the rest is out of bounds."""
    drawn = F.rand(7)
    events = spark.range(20_000).select(drawn.alias("u")).select(
        F.when(F.col("u") < 0.5, 5000).otherwise(1).alias("deviceId"),
        F.when(F.col("u") < 0.9, 50).otherwise(150).alias("temperature"),
    )
    kept = streams.device_filter(events)
    share = kept.count() / 20_000, kept.where(~streams.within("temperature")).count() / kept.count()
    assert share == (pytest.approx(0.5, abs=0.02), pytest.approx(0.2, abs=0.02))


def test_monitoring_of_a_stream(spark, landing):
    from brightmere.operators import observe

    def at(hour, name, count):
        return {"time_generated": f"2024-01-01T{hour:02d}:00:00", "name": name, "count": count, "value": count}

    spilled, memory = "app.1.executor.diskBytesSpilled", "app.1.shuffle-client.usedHeapMemory"
    stream = landing(at(1, spilled, 5.0), at(1, spilled, 9.0), at(1, memory, 3.0), at(9, memory, 1.0), at(9, spilled, 9.0))
    rows = stream.select(F.from_json("body", observe.METRICS).alias("m")).select("m.*")
    rows = rows.withColumn("time_generated", F.col("time_generated").cast("timestamp"))
    found = {}
    for label, family in (("delta", observe.counter_deltas), ("gauge", observe.gauge_p90)):
        path = scratch(spark, label)
        run(streams.sink_files(family(rows, "1 hour"), path, scratch(spark, "c")))
        found[label] = values(spark.read.parquet(path).select("query", "slice", "value"))
    assert found["delta"] == [("disk_bytes_spilled", "app.1", 4.0), ("shuffle_disk_spilled_per_executor", "executorid:1", 4.0)]
    assert found["gauge"] == [("shuffle_heap_memory", "app.1", 3.0)]


def test_progress_is_kept(spark, landing):
    import time

    from brightmere.operators import observe

    log = streams.ProgressLog(spark, scratch(spark, "progress"))
    spark.streams.addListener(log)
    try:
        stream = landing("a", "b")
        query = stream.writeStream.format("noop").queryName("kept").trigger(availableNow=True)
        run(query.option("checkpointLocation", scratch(spark, "c")).start())
        for _ in range(100):
            time.sleep(0.2)
            try:
                if log.read().where("progress_name = 'kept'").count():
                    break
            except Exception:  # nothing was written yet
                continue
    finally:
        spark.streams.removeListener(log)
    found = {r.query for r in observe.stream_p90(log.read(), "1 hour").collect()}
    assert found == {"stream_trigger_latency", "stream_processed_rows", "stream_input_rows"}


def test_streamed_families_give_the_rows_of_the_stored_log(spark, tmp_path):
    """Starts and ends in any order over many batches, repeated and late starts; a batch that is
    written again changes nothing."""
    from brightmere.operators import observe

    t = dt.datetime(2024, 1, 1)
    hour = dt.timedelta(hours=1)
    rows = []
    for i in range(40):
        app, at = f"a{i % 3}", t + i * hour / 7
        rows += [
            {"event": observe.COMPLETED, "stage_id": i, "stage_name": f"s{i % 4}", "stage_submission": 1.0 * i, "stage_completion": i * 2.5 + 1},
            {"event": observe.TASK_END, "stage_id": i, "task_reason": "Success" if i % 5 else "Killed"},
            {"event": observe.SUBMITTED, "stage_id": i, "stage_name": f"s{i % 4}"},
            {"event": observe.SUBMITTED, "stage_id": i, "stage_name": "again"},
            {"event": observe.JOB_END, "job_id": i, "completion": 3.0 * i, "job_result": "JobSucceeded" if i % 2 else "JobFailed"},
            {"event": observe.JOB_START, "job_id": i, "submission": 1.0 * i, "call_site": f"site {i % 2}"},
            {"event": "Log", "level": "ERROR", "progress_name": "p"},
        ]
        for n, row in enumerate(rows[-7:]):
            row |= {"app_id": app, "cluster": "c", "time_generated": at + n * hour / 100}
    log = spark.createDataFrame([], observe.EVENTS)
    log = spark.createDataFrame([tuple(r.get(f.name) for f in log.schema) for r in rows], log.schema)
    folder = str(tmp_path / "log")
    log.repartition(7).write.parquet(folder)
    stream = streams.file_stream(spark, folder, log.schema, files_per_trigger=1)
    for family, batch in (("event_counts", observe.event_counts), ("duration_quantiles", observe.duration_quantiles)):
        path = scratch(spark, family)
        for checkpoint in ("c1", "c2"):  # the second run writes the same batches once more
            run(observe.keep_counts(stream, family, path, scratch(spark, checkpoint), "1 hour"))
        found = observe.kept_counts(spark, family, path, "1 hour")
        assert values(found) == values(batch(log, "1 hour"))
        assert found.count() > 5 and spark.read.parquet(path).select("_batch").distinct().count() == 7
