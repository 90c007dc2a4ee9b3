"""Layouts of folders that grow by copies or batches: kept beside the rows, refused before a write.

The folder ``_layouts`` below a target holds each different layout that was written there.
Spark's readers pass over it, and a read knows all columns without opening a file.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from brightmere.sources.versions import merged

NOTED = "layout STRING, noted_at TIMESTAMP"


def noted(spark: SparkSession, path: str) -> list[StructType]:
    """The layouts written to a folder, the oldest first."""
    try:
        rows = spark.read.schema(NOTED).parquet(f"{path}/_layouts").groupBy("layout").agg(F.min("noted_at").alias("at"))
        return [StructType.fromJson(json.loads(r["layout"])) for r in rows.orderBy("at", "layout").collect()]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def agree(df: DataFrame, path: str) -> None:
    """Note the layout of rows about to be written to a folder; a column of another type than
    in earlier rows is refused, new columns are not."""
    spark = df.sparkSession
    known = noted(spark, path)
    if df.schema in known:
        return
    _, conflicts = merged([*known, df.schema])
    if conflicts:
        raise ValueError(f"columns of another type than in {path}: {sorted(conflicts)}")
    entry = spark.range(0, 1, 1, 1).select(F.lit(df.schema.json()).alias("layout"), F.current_timestamp().alias("noted_at"))
    entry.write.mode("append").parquet(f"{path}/_layouts")


def read_all(spark: SparkSession, path: str, partition: str, kind: str = "string") -> DataFrame:
    """All rows of a folder with the columns of all its layouts (NULL where a row has none).

    A folder written before layouts were noted is asked file by file.
    """
    known = noted(spark, path)
    if not known:
        return spark.read.option("mergeSchema", True).parquet(path).drop(partition)
    columns, _ = merged(known)
    return spark.read.schema(StructType([*columns.fields]).add(partition, kind)).parquet(path).drop(partition)
