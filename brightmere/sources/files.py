"""File and catalog scans."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def _schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def identifier(name: str) -> str:
    """``name`` if it is a plain (dotted) identifier, so that it can go into SQL text."""
    if not re.fullmatch(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)*", name):
        raise ValueError(f"not a table or view name: {name!r}")
    return name


def sql_text(value: object) -> str:
    """``value`` as a SQL literal text, or NULL."""
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    multiline: bool = False,
    bad_path: str | None = None,
    load_id: str | None = None,
) -> DataFrame:
    """JSON (lines, or one document per file with ``multiline``).

    With ``bad_path`` the records that do not parse are stored there with their source file (a
    pass over the input), and the returned frame holds only the others. They lie in a partition
    ``load_id=...`` of their own, which a repeated run of the same load replaces; a load without a
    name is named after its path. Without a schema Spark infers one, which costs a pass over
    the input.
    """
    reader = spark.read.option("multiLine", multiline).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.json(path)
    schema = _schema(schema)
    if bad_path is None:
        return reader.schema(schema).json(path)
    good, bad = read_json_split(spark, path, schema, multiline)
    name = load_id or hashlib.md5(path.encode()).hexdigest()
    bad.write.mode("overwrite").json(f"{bad_path}/load_id={name}")
    return good


def read_json_split(
    spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The parsed records, and those that do not parse: source file, raw text, and what did."""
    schema = _schema(schema)
    with_text = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    rows = (
        spark.read.schema(with_text)
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    good = rows.where(F.col(CORRUPT).isNull()).select(*schema.names)
    bad = rows.where(F.col(CORRUPT).isNotNull()).select(
        "source_file", F.col(CORRUPT).alias("record"), *schema.names
    )
    return good, bad


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    infer: bool = False,
    mode: str = "PERMISSIVE",
    sep: str = ",",
    quote: str = '"',
    escape: str = "\\",
) -> DataFrame:
    """Delimited text: all strings, inferred types, or a typed layout.

    ``mode="FAILFAST"`` rejects the whole read at the first bad field (reject limit 0).
    """
    reader = (
        spark.read.option("header", header)
        .option("mode", mode)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", escape)
    )
    if schema is not None:
        return reader.schema(_schema(schema)).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_parquet_many(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several Parquet files as one frame, matched by column name; absent columns are NULL."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def monthly_paths(pattern: str, year: int, months: range = range(1, 13)) -> list[str]:
    """``pattern`` filled with ``{year}`` and a two-digit ``{month}``."""
    return [pattern.format(year=year, month=f"{month:02d}") for month in months]


def register_glob_view(spark: SparkSession, glob: str, name: str) -> DataFrame:
    """A temporary view over every Parquet file that matches ``glob``."""
    spark.read.parquet(glob).createOrReplaceTempView(identifier(name))
    return spark.table(name)


def create_partition_view(
    spark: SparkSession, table: str, year: int, month: int, name: str | None = None
) -> str:
    """A view of one month of a table partitioned by ``year`` and ``month``.

    The predicate is on the partition columns, so reading the view lists one folder.
    """
    view = identifier(name or f"{table.split('.')[-1]}_{int(year):04d}_{int(month):02d}")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {view} AS "
        f"SELECT * FROM {identifier(table)} WHERE year = {int(year)} AND month = {int(month)}"
    )
    return view


def external_table(
    spark: SparkSession, name: str, path: str, ddl: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A catalog table over a folder that already exists."""
    columns = f"({ddl})" if ddl else ""
    spark.sql(
        f"CREATE TABLE {identifier(name)} {columns} USING {identifier(fmt)} LOCATION {sql_text(path)}"
    )
    return spark.table(name)


def indicator_facts(df: DataFrame) -> DataFrame:
    """The flat (indicator, country, date, value) form of nested indicator records."""
    return df.select(
        F.col("indicator.id").alias("indicator_id"),
        F.col("country.value").alias("country"),
        F.col("date"),
        F.col("value"),
    )
