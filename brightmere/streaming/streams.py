"""Stream sources, filters, splits and sinks."""

from __future__ import annotations

import json
import threading

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from brightmere.sources import layouts

# The limits of the filters.
WARM, DEVICES, BOUND, LATE_SECONDS = 27, 1000, 100, 5


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def message_bus_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Messages of a topic as (body, arrival); needs Spark's Kafka package."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("body"), F.col("timestamp").alias("arrival"))


_CORRUPT = "_corrupt_record"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
_WHOLE = ("byte", "short", "integer", "long")


def _readable(body: Column, schema: StructType, compat: bool) -> Column:
    """The record of a message as an array of one, empty when the message is dead.

    The array binds the parsed record once; conditions on columns of a parsed struct would
    be pushed below it by the optimiser, each with a parse of its own.
    """
    layout = StructType(list(schema.fields)).add(_CORRUPT, "string")

    def alive(m: Column) -> Column:
        fine = m.isNotNull() & m.getField(_CORRUPT).isNull()
        if not compat:
            for name in schema.names:
                fine = fine & m.getField(name).isNotNull()
        return fine

    def filled(m: Column) -> Column:
        values = []
        for f in schema.fields:
            value = m.getField(f.name)
            if compat and f.dataType.typeName() in _WHOLE:
                value = F.coalesce(value, F.lit(0).cast(f.dataType))
            values.append(value.alias(f.name))
        return F.struct(*values)

    parsed = F.array(F.from_json(body, layout, _PERMISSIVE))
    return F.transform(F.filter(parsed, alive), filled)


def decode(
    stream: DataFrame, schema: StructType, body: str = "body", compat: bool = False
) -> tuple[DataFrame, DataFrame]:
    """JSON messages as (readable rows with the schema's columns, dead letters).

    A message is dead when it is no JSON object of that layout or lacks a field. With
    ``compat`` a missing whole number is 0 and only broken messages are dead. Columns
    besides the schema's are carried along.
    """
    readable = _readable(F.col(body), schema, compat)
    rest = [c for c in stream.columns if c not in schema.names]
    return stream.select(*rest, F.inline(readable)), stream.where(F.size(readable) == 0)


def encode(df: DataFrame, cols: list[str] | None = None, body: str = "body") -> DataFrame:
    """Add the JSON text of some columns (all by default)."""
    return df.withColumn(body, F.to_json(F.struct(*(cols or df.columns))))


def filter_above(stream: DataFrame, col: str, limit: float = WARM) -> DataFrame:
    return stream.where(F.col(col) > limit)


def device_filter(stream: DataFrame, col: str = "deviceId", limit: int = DEVICES) -> DataFrame:
    return stream.where(F.col(col) < limit)


def within(col: str, limit: float = BOUND) -> Column:
    """Whether a value is in bounds; exactly the limit is out."""
    return F.col(col) < limit


def sink_files(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the stream to Parquet files, each row once."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


BATCH = "_batch"


def split_by_limit(
    stream: DataFrame,
    col: str,
    limit: float,
    ok_path: str,
    out_path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Rows in bounds to one folder, the others (NULL too) to a second one.

    A micro-batch that is replayed after a failure replaces the partitions it wrote before. A
    column of another type than in earlier batches is refused.
    """
    agreed: set[str] = set()

    def write(batch: DataFrame, number: int) -> None:
        in_bounds = F.coalesce(within(col, limit), F.lit(False))
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        for path, rows in ((ok_path, kept.where(in_bounds)), (out_path, kept.where(~in_bounds))):
            _store(rows, path, number, agreed)
        kept.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """What ``split_by_limit`` or ``keep_decoded`` wrote, with the columns of all batches."""
    return layouts.read_all(spark, path, BATCH, "long")


def _store(rows: DataFrame, path: str, number: int, agreed: set[str]) -> None:
    """Write a micro-batch in place of what an earlier attempt wrote. The layout is agreed on once
    for each path of a running query."""
    if path not in agreed:
        layouts.agree(rows, path)
        agreed.add(path)
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")


def keep_decoded(
    stream: DataFrame,
    schema: StructType,
    good_path: str,
    dead_path: str,
    checkpoint: str,
    compat: bool = False,
    **trigger,
) -> StreamingQuery:
    """Decode messages, store the readable and the dead ones, and count both per batch.

    A dead message neither stops the batch nor is lost; the counts are in the progress
    reports of the query under ``decode``. Each message is parsed once.
    """
    rest = [c for c in stream.columns if c not in schema.names]
    agreed: set[str] = set()

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        good = kept.select(*rest, F.inline("_record"))
        dead = kept.where(F.size("_record") == 0).drop("_record")
        for path, rows in ((good_path, good), (dead_path, dead)):
            _store(rows, path, number, agreed)
        kept.unpersist()

    decoded = stream.withColumn("_record", _readable(F.col("body"), schema, compat))
    observed = decoded.observe(
        "decode",
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.size("_record") == 0).alias("dead"),
    )
    return (
        observed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def telemetry_rows(stream: DataFrame, device: str, event_time: str, id: str, buckets: int = 64) -> DataFrame:
    """Telemetry keyed by (device, time, id) with its full JSON and a bucket of the device.

    The bucket spreads devices over folders; one busy device fills several files of its
    folder, not one task.
    """
    encoded = encode(stream)
    return encoded.select(
        F.pmod(F.hash(F.col(device)), F.lit(buckets)).alias("bucket"),
        F.col(device).cast("string").alias("device"),
        F.col(event_time).alias("event_time"),
        F.col(id).alias("id"),
        F.col("body"),
    )


def sink_telemetry(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .partitionBy("bucket")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def clamp_late(
    df: DataFrame, event: str, arrival: str, seconds: int = LATE_SECONDS, name: str = "adjusted"
) -> DataFrame:
    """Move event times that are later than the limit behind their arrival to the limit.

    Nothing is dropped. An event time after its arrival stays.
    """
    earliest = F.col(arrival) - F.make_dt_interval(secs=F.lit(seconds))
    return df.withColumn(name, F.greatest(F.col(event), earliest))


def dedupe(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """One row per key among rows that arrive within ``delay`` of each other."""
    if not stream.isStreaming:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


PROGRESS = """query_id STRING, batch_id BIGINT, ts STRING, event STRING, progress_name STRING,
    trigger_execution DOUBLE, progress_sources STRING"""


def _progress_row(report, name: str | None) -> tuple:
    sources = [
        {
            "numInputRows": s.numInputRows,
            "inputRowsPerSecond": s.inputRowsPerSecond,
            "processedRowsPerSecond": s.processedRowsPerSecond,
        }
        for s in report.sources
    ]
    return (
        str(report.id),
        report.batchId,
        report.timestamp.rstrip("Z"),
        "QueryProgressEvent",
        name or report.name,
        float(report.durationMs.get("triggerExecution", 0)),
        json.dumps(sources),
    )


def _event_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("time_generated", F.col("ts").cast("timestamp_ntz")).drop("ts")


class ProgressLog(StreamingQueryListener):
    """Appends every progress report of the session's streams to a folder.

    A query itself remembers only its last reports; add this with
    ``spark.streams.addListener`` to keep all of them, and read them with ``read``. Reports
    are written when a stream ends, when they are read, and in lots of ``lot``.
    """

    def __init__(self, spark: SparkSession, path: str, lot: int = 100):
        self.spark, self.path, self.lot = spark, path, lot
        self._rows, self._ended, self._news = [], set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._news:
            self._rows.append(_progress_row(event.progress, None))
        if len(self._rows) >= self.lot:
            self._write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._write()
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def _write(self) -> None:
        with self._news:
            rows, self._rows = self._rows, []
            if rows:
                frame = self.spark.createDataFrame(rows, PROGRESS).coalesce(1)
                frame.write.mode("append").parquet(self.path)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the reports of an ended query have arrived, which Spark delivers a little later."""
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"the end of query {query.runId} was not reported")

    def read(self) -> DataFrame:
        self._write()
        return _event_rows(self.spark.read.schema(PROGRESS).parquet(self.path))
