"""Removal of rows and partitions past their time."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from brightmere.operators.load import by_partition
from brightmere.session import remove_folders, scratch
from brightmere.sources import versions
from brightmere.sources.files import identifier, sql_text


def keep_rows(df: DataFrame, ts: str, cutoff: dt.datetime) -> DataFrame:
    """Rows not before ``cutoff``; rows without a time stay."""
    limit = F.lit(cutoff.isoformat(sep=" ")).cast(df.schema[ts].dataType)
    return df.where((F.col(ts) >= limit) | F.col(ts).isNull())


def retain_rows(
    spark: SparkSession, table: str, ts: str, cutoff: dt.datetime, partitions: list[str]
) -> int:
    """Delete rows before ``cutoff`` from a partitioned table; returns how many.

    One pass over the times alone tells which partitions expire whole and which in part. The
    former are dropped unread, in one statement. What the latter keep is staged and replaces
    them; the staged rows go afterwards. Other partitions keep their files. The list of affected
    partitions, not of rows, comes to the driver.
    """
    rows = spark.table(identifier(table))
    limit = F.lit(cutoff.isoformat(sep=" ")).cast(rows.schema[ts].dataType)
    zones = rows.groupBy(*partitions).agg(F.count_if(F.col(ts) < limit).alias("_old"), F.count(F.lit(1)).alias("_all"))
    affected = zones.where("_old > 0").collect()
    if not affected:
        return 0
    mixed = [r for r in affected if r["_old"] < r["_all"]]
    if mixed:
        kept = keep_rows(rows.where(reduce(lambda a, b: a | b, [_is(r, partitions) for r in mixed])), ts, cutoff)
        staging = scratch(spark, "retained")
        kept.write.parquet(staging)
        staged = spark.read.schema(kept.schema).parquet(staging).select(*rows.columns)
        root = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
        writer = by_partition(staged, *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partitions).parquet(root)
        spark.catalog.refreshTable(table)
        remove_folders(spark, [staging])
    emptied = [r for r in affected if r["_old"] == r["_all"]]
    if emptied:
        specs = ", ".join("PARTITION (" + ", ".join(f"{p} = {sql_text(r[p])}" for p in partitions) + ")" for r in emptied)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return sum(r["_old"] for r in affected)


def _is(row: Row, partitions: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(row[p])) for p in partitions])


def retain_version(spark: SparkSession, root: str, ts: str, cutoff: dt.datetime) -> int:
    """Commit a version without the rows before ``cutoff`` and remove the ones before it; the
    newest version. Commits whose zone does not reach ``cutoff`` are dropped unread, or stay."""
    versions.retain(spark, root, ts, cutoff)
    versions.vacuum(spark, root)
    return versions.current_version(spark, root)


def retention_plan(partitions: DataFrame, cutoff: dt.date) -> DataFrame:
    """(year, month, action, drop_year) for a list of month partitions.

    A month is dropped when all of it lies before ``cutoff``; ``drop_year`` marks years that
    keep no month.
    """
    month_end = F.last_day(F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1)))
    planned = partitions.select(
        "year",
        "month",
        F.when(month_end < F.lit(cutoff.isoformat()).cast("date"), "drop").otherwise("keep").alias("action"),
    )
    years = planned.groupBy("year").agg(F.every(F.col("action") == "drop").alias("drop_year"))
    return planned.join(years, "year").select("year", "month", "action", "drop_year")
