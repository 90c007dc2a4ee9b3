"""Incremental copies: high-water marks, change feeds and re-ingest decisions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from brightmere.operators.joins import enrich
from brightmere.operators.load import append_path
from brightmere.sources import layouts, versions

# Fixed value: the mark of a table that was never copied.
FIRST_MARK = dt.datetime(1900, 1, 1)
MARKS_LAYOUT = "name STRING, mark TIMESTAMP_NTZ, written_at TIMESTAMP"
MARKERS_LAYOUT = "name STRING, version BIGINT, written_at TIMESTAMP"
FROM_MARK = "_from_mark"


def _latest(spark: SparkSession, path: str, layout: str, name: str, column: str):
    """The newest entry under ``name`` of a small append-only table, or None."""
    try:
        entries = spark.read.schema(layout).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # Marks only grow, so the newest is the greatest.
    return entries.where(F.col("name") == name).agg(F.max(column)).first()[0]


def _note(spark: SparkSession, path: str, layout: str, name: str, value: object) -> None:
    column, kind = layout.split(", ")[1].split()
    row = spark.range(0, 1, 1, 1).select(
        F.lit(name).alias("name"),
        F.lit(str(value)).cast(kind).alias(column),
        F.current_timestamp().alias("written_at"),
    )
    append_path(row, path)


def watermark(spark: SparkSession, marks: str, name: str) -> dt.datetime:
    """The high-water mark of ``name``."""
    return _latest(spark, marks, MARKS_LAYOUT, name, "mark") or FIRST_MARK


def hwm_range(df: DataFrame, col: str, old: object, new: object) -> DataFrame:
    """Rows after ``old`` and up to ``new``."""
    return df.where((F.col(col) > F.lit(old)) & (F.col(col) <= F.lit(new)))


def hwm_copy(
    src: DataFrame, dst: str, col: str, marks: str, name: str
) -> tuple[dt.datetime, dt.datetime]:
    """Copy the rows of ``src`` beyond the stored mark to the folder ``dst``; (old, new) mark.

    The increment is the partition of ``dst`` named after the old mark, and the mark is
    written last: a run that fails in between is repeated from the same mark and replaces
    its own partition. ``col`` is a zone-less timestamp. A column of another type than in
    earlier copies is refused before anything is written; new columns are not.
    """
    spark = src.sparkSession
    old = watermark(spark, marks, name)
    # The filter comes before the maximum, so that the scan skips what was copied.
    beyond = src.where(F.col(col) > F.lit(old).cast("timestamp_ntz"))
    new = beyond.agg(F.max(F.col(col).cast("timestamp_ntz"))).first()[0]
    if new is None:
        return old, old
    rows = beyond.where(F.col(col) <= F.lit(new).cast("timestamp_ntz"))
    layouts.agree(rows, dst)
    rows.write.mode("overwrite").parquet(f"{dst}/{FROM_MARK}={old:%Y%m%dT%H%M%S%f}")
    _note(spark, marks, MARKS_LAYOUT, name, new)
    return old, new


def read_increments(spark: SparkSession, dst: str) -> DataFrame:
    """Everything copied to ``dst`` so far, with the columns of all copies (NULL where one lacks them)."""
    return layouts.read_all(spark, dst, FROM_MARK)


def filter_month_version(df: DataFrame, col: str, version: int) -> DataFrame:
    """Rows dated the first of the month ``version`` months after the earliest date's month."""
    kind = df.schema[col].dataType.typeName()
    if kind not in ("date", "timestamp", "timestamp_ntz"):
        raise TypeError(f"{col} is {kind}, not a date")
    start = df.agg(F.min(F.col(col).cast("date"))).first()[0]
    if start is None:
        return df.limit(0)
    months = start.year * 12 + start.month - 1 + version
    month = dt.date(months // 12, months % 12 + 1, 1)
    return df.where(F.col(col) == F.lit(month.isoformat()).cast(kind))


def marker(spark: SparkSession, marks: str, name: str) -> int:
    """The first change-feed version that was not read yet."""
    found = _latest(spark, marks, MARKERS_LAYOUT, name, "version")
    return 0 if found is None else found


def cdf_increment(
    spark: SparkSession, root: str, marks: str, name: str, ref: DataFrame, on: str | list[str]
) -> tuple[DataFrame, DataFrame, int]:
    """Changes not read yet, with context from ``ref``: (enriched, changes, next marker).

    Both frames are empty when there is nothing new. Pass the marker to ``confirm`` once the
    rows are stored; until then the same changes come again.
    """
    newest = versions.current_version(spark, root)
    changes = versions.changes_since(spark, root, marker(spark, marks, name), newest)
    return enrich(changes.drop(versions.VERSION), ref, on), changes, newest + 1


def confirm(spark: SparkSession, marks: str, name: str, version: int) -> None:
    """Store the marker after a successful increment."""
    _note(spark, marks, MARKERS_LAYOUT, name, version)


def reingest_plan(config: DataFrame, tolerance_seconds: int = 1) -> DataFrame:
    """The entries to copy: never copied, or changed at the source since.

    ``config`` has text columns lastUpdatedSourceSystem and lastUpdatedDatalake; an entry
    without the latter is new. A source time within the tolerance before the copy counts
    as a change.
    """
    source = F.col("lastUpdatedSourceSystem").try_cast("timestamp")
    copied = F.nullif(F.col("lastUpdatedDatalake"), F.lit("")).try_cast("timestamp")
    slack = F.make_interval(secs=F.lit(tolerance_seconds))
    reason = F.when(copied.isNull(), "new").when(source >= copied - slack, "changed")
    return config.withColumn("reason", reason).where(F.col("reason").isNotNull())
