"""Text sources: storage access logs and ``name: value`` messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from brightmere.operators.load import by_partition

# The fields of one access-log line, in order.
ACCESS_LOG_FIELDS = """
version-number request-start-time operation-type request-status http-status-code
end-to-end-latency-in-ms server-latency-in-ms authentication-type requester-account-name
owner-account-name service-type request-url requested-object-key request-id-header
operation-count requester-ip-address request-version-header request-header-size
request-packet-size response-header-size response-packet-size request-content-length
request-md5 server-md5 etag-identifier last-modified-time conditions-used
user-agent-header referrer-header client-request-id
""".split()


def parse_access_log(spark: SparkSession, path: str) -> DataFrame:
    """Access-log lines as named text columns; a quoted ``;`` stays inside its field."""
    layout = StructType([StructField(name, StringType()) for name in ACCESS_LOG_FIELDS])
    return (
        spark.read.schema(layout)
        .option("sep", ";")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def access_log_json(df: DataFrame) -> DataFrame:
    """One JSON text per access-log row, ready for shipping; absent fields are empty text."""
    fields = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns]
    return df.select(F.to_json(F.struct(*fields)).alias("body"))


def parse_pair(line: Column) -> tuple[Column, Column]:
    """Name and value of a ``name: value`` line; text after a second colon is dropped."""
    parts = F.split(line, ":")
    return F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))


def stack_messages(df: DataFrame) -> DataFrame:
    """(topic, ts, text) messages as one row per line: (topic, ts, position, name, value)."""
    lines = df.select("topic", "ts", F.posexplode(F.split("text", "\n")).alias("position", "line"))
    name, value = parse_pair(F.col("line"))
    return lines.select("topic", "ts", "position", name.alias("name"), value.alias("value"))


def topic_table(df: DataFrame, topic: str) -> DataFrame:
    """The messages of one topic as rows: ts and one column per name of their lines.

    Every name of every message is a column, in the order of its first position in a
    message, then by name; a name that comes again in a message gets a number. Values go
    by name. A line that a message lacks, or that has no value, is NULL; lines without a
    name are left out. Only the names come to the driver.
    """
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(*_named_pair(line)))
    named = F.filter(lines, lambda pair: pair["name"] != "")
    own = df.where(F.col("topic") == topic).select("ts", named.alias("_lines"))

    def numbered(pair: Column, i: Column) -> Column:
        before = F.slice("_lines", F.lit(1), i)
        times = F.size(F.filter(before, lambda other: other["name"] == pair["name"]))
        key = F.concat((times + 1).cast("string"), F.lit(":"), pair["name"])
        return F.struct(key.alias("key"), pair["value"].alias("value"))

    cells = own.select("ts", F.transform("_lines", numbered).alias("_cells"))
    seen = cells.select(F.posexplode("_cells.key").alias("position", "key"))
    keys = seen.groupBy("key").agg(F.min("position").alias("position")).orderBy("position", "key")
    columns, taken = [], {"ts"}
    for row in keys.collect():
        times, name = row["key"].split(":", 1)
        label, number = (name, 1) if times == "1" else (f"{name}_{times}", int(times))
        while label.lower() in taken:
            number += 1
            label = f"{name}_{number}"
        taken.add(label.lower())
        columns.append(F.try_element_at("_values", F.lit(row["key"])).alias(label))
    return cells.select("ts", F.map_from_entries("_cells").alias("_values")).select("ts", *columns)


def _named_pair(line: Column) -> tuple[Column, Column]:
    name, value = parse_pair(line)
    return name.alias("name"), value.alias("value")


def topic_file(topic: Column) -> Column:
    """A topic as a file-system safe name."""
    return F.replace(topic, F.lit("/"), F.lit("_slash_"))


def write_topics(df: DataFrame, path: str) -> None:
    """Stacked messages as one folder per topic."""
    named = df.withColumn("topic", topic_file(F.col("topic")))
    by_partition(named, "topic").write.mode("overwrite").partitionBy("topic").parquet(path)
