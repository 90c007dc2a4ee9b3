"""What several operators of this folder share: staging, block sums, components."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from brightmere.session import scratch

FEW_EDGES = 1 << 18  # so many links, 4 MB, are joined by one task


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: the cut of a lineage that
    survives lost executors. The folder stays until the shared folder is cleared."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """``staged``, with files dealt by ``key`` into as many buckets as a shuffle has partitions:
    a join on ``key`` moves the other side only. It is an external table of the session's catalog."""
    spark = df.sparkSession
    path = scratch(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return spark.table(name)


def remainder(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; null where the column is null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def chunks(batches: Iterator[pa.RecordBatch], text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose texts have about ``most`` bytes together,
    so that what a task holds depends on its longest text and not on its number of rows."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pc.binary_length(column).fill_null(0), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            total = np.cumsum(sizes[at:])
            n = max(1, int(np.searchsorted(total, most)))
            yield batch.slice(at, n)
            at += n


def summed(parts: DataFrame, dtype: str = "float64") -> dict[int, np.ndarray]:
    """Sum arrays by block. ``parts`` has (block int, data binary); blocks of one number have
    one length. Tasks add what they read one after the other, in two rounds, so a task holds
    one array for each block and the driver gets one array for each block."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(data, dtype)
                if block in held:
                    held[block] += part
                else:
                    held[block] = part.copy()
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())],
                ["block", "data"],
            )

    kind = "block int, data binary"
    first = parts.select("block", "data", (F.spark_partition_id() % 16).alias("salt"))
    first = first.repartition("block", "salt").drop("salt").mapInArrow(add, kind)
    rows = first.repartition("block").mapInArrow(add, kind).collect()
    return {r["block"]: np.frombuffer(bytes(r["data"]), dtype) for r in rows}


def forest(edges: Iterator[tuple[int, int]]) -> dict[int, int]:
    """The smallest id that each id of ``edges`` can reach."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above[up]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        above[high] = low
    return {x: root(x) for x in list(above)}


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id of ``edges`` (a long, b long); component is the smallest id
    that can be reached. Alternates large and small stars until nothing changes or no more than
    ``FEW_EDGES`` are left, which one task joins; each step is minima by key (combined before the
    shuffle) and a join back that may split large keys."""
    def kept(rows: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()
        mark = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        return staged(rows.observe(seen, *mark), "stars"), seen.get

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = forest(e for x in batches for e in zip(x.column(0).to_pylist(), x.column(1).to_pylist()))
        made = [pa.array(x, pa.int64()) for x in (found.keys(), found.values())]
        yield pa.RecordBatch.from_arrays(made, ["id", "component"])

    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now, mark = kept(links)
    before = None
    while mark["n"] > FEW_EDGES and mark != before:
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        now, mark = kept(small.where("u <> v").distinct())
    if mark["n"] <= FEW_EDGES:
        return staged(now.coalesce(1).mapInArrow(joined, "id bigint, component bigint"), "joined")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def sample_ids(df: DataFrame, by: str, key: str, most: int) -> DataFrame:
    """At most ``most`` of the distinct rows of each value of ``by``, those with the smallest
    hashes of ``key``, with their ``place``, staged. The values of ``by`` are a model's classes;
    by their counts, all but about twice the wanted rows are left out where they are read."""
    sizes = {r[by]: r["count"] for r in df.groupBy(by).count().collect()}
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col(by) == F.lit(value), F.lit((2 * most + 100) / n)).otherwise(share)
    near = df.where(F.xxhash64(key).cast("double") / 2.0**64 + 0.5 <= share).distinct()
    order = Window.partitionBy(by).orderBy(F.xxhash64(key), key)
    ranked = near.withColumn("place", F.row_number().over(order))
    return staged(ranked.where(F.col("place") <= most), "sample")


def once(name: str, make):
    """A value that a Python worker keeps between tasks, by name."""
    kept = sys.modules[__name__].__dict__.setdefault("_kept", {})
    if name not in kept:
        kept.clear()
        kept[name] = make()
    return kept[name]
