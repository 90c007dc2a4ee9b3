"""Writes into tables and folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brightmere.functions.calendar import FOREVER
from brightmere.session import remove_folders, scratch, scratch_name
from brightmere.sources.files import identifier, read_csv, sql_text


def _ordered(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the table's column order, because inserts go by position."""
    return df.select(*df.sparkSession.table(table).columns)


def by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` arranged for a write partitioned by ``columns``.

    Rows of a partition come together, so it gets few files; adaptive execution splits the
    partitions that are large and joins the small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def append_into(df: DataFrame, table: str) -> None:
    _ordered(df, table).write.insertInto(table)


def append_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).save(path)


def overwrite_self(spark: SparkSession, df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a table by rows computed from it; a table that does not exist yet is created
    (at ``path``).

    The rows go to a scratch folder first: a failure before the final copy leaves the table
    as it was.
    """
    if not spark.catalog.tableExists(identifier(table)):
        create_or_append(df, table, path)
        return
    staging = scratch(spark, "staging")
    _ordered(df, table).write.parquet(staging)
    spark.read.parquet(staging).write.insertInto(table, overwrite=True)
    remove_folder(spark, staging)


def create_or_append(df: DataFrame, table: str, path: str | None = None) -> str:
    """Create the table from ``df`` or append to it; returns which of the two was done."""
    if df.sparkSession.catalog.tableExists(identifier(table)):
        append_into(df, table)
        return "appended"
    writer = df.write.format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return "created"


def truncate_load(df: DataFrame, table: str, casts: dict[str, str] | None = None) -> None:
    """Replace the table's rows by ``df``, with some columns cast."""
    casts = casts or {}
    typed = df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()})
    _ordered(typed, table).write.insertInto(table, overwrite=True)


def reload_idempotent(df: DataFrame, table: str, load_id: str) -> None:
    """Replace one load of a table partitioned by ``load_id``; other loads are not touched.

    The partition is named in the statement, so a load without rows empties it.
    """
    spark = df.sparkSession
    columns = [c for c in spark.table(table).columns if c != "load_id"]
    view = scratch_name("reload")
    rows = df.where(F.col("load_id") == load_id) if "load_id" in df.columns else df
    rows.select(*columns).createOrReplaceTempView(view)
    spark.sql(
        f"INSERT OVERWRITE TABLE {identifier(table)} PARTITION (load_id = {sql_text(load_id)}) "
        f"SELECT * FROM {view}"
    )
    spark.catalog.dropTempView(view)


def seed_if_empty(df: DataFrame, table: str) -> bool:
    """Append ``df`` if the table has no row; says whether it did."""
    if not df.sparkSession.table(table).isEmpty():
        return False
    append_into(df, table)
    return True


def load_dw(
    spark: SparkSession,
    dims: dict[str, tuple[DataFrame, dict[str, str]]],
    facts: dict[str, DataFrame],
    load_id: str,
) -> None:
    """Reload dimension tables in full and one load of the fact tables."""
    for table, (df, casts) in dims.items():
        truncate_load(df, table, casts)
    for table, df in facts.items():
        reload_idempotent(df, table, load_id)


def create_tables(spark: SparkSession, spec: dict, root: str | None = None) -> list[str]:
    """Create the tables of a configuration; those of data files below ``root``, if given.

    ``spec["table_types"]`` is a list of groups with ``tables``; a table has a
    ``table_name`` and a ``data_file`` (a CSV with header, loaded in overwrite mode) or else
    a ``create_sql``. Faulty entries do not stop the others; they are raised together.
    """
    created, errors = [], []
    for group in spec["table_types"]:
        for table in group["tables"]:
            name = table.get("table_name")
            try:
                if table.get("data_file"):
                    writer = read_csv(spark, table["data_file"]).write.mode("overwrite")
                    if root is not None:
                        writer = writer.option("path", f"{root}/{name}")
                    writer.saveAsTable(identifier(name))
                elif table.get("create_sql"):
                    spark.sql(table["create_sql"])
                else:
                    raise ValueError("neither data_file nor create_sql is given")
                created.append(name)
            except Exception as error:  # collected, raised below
                errors.append(f"{name}: {error}")
    if errors:
        raise ValueError("tables not created: " + "; ".join(errors))
    return created


def dated_snapshot(df: DataFrame, root: str, source: str, day: dt.date) -> str:
    """Write today's copy, replacing an earlier one of the same day."""
    path = f"{root}/{source}/{day:%Y-%m}/{day:%Y-%m-%d}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def audit_counts(df: DataFrame, file: str, run_id: str) -> DataFrame:
    """One row: date, file, run and number of rows."""
    return df.agg(F.count(F.lit(1)).alias("count")).select(
        F.current_date().alias("date"),
        F.lit(file).alias("filename"),
        F.lit(run_id).alias("pipeline_run_id"),
        "count",
    )


def convert(
    spark: SparkSession, source: str, target: str, casts: dict[str, str],
    rejects: str | None = None, **dialect,
) -> int:
    """Copy CSV files (a folder or glob) to Parquet, converting some columns.

    A value that does not convert fails the copy; with ``rejects`` its whole row goes there
    instead, as text and with the names of such columns in ``_failed``. Both folders are
    replaced, so a repeated copy leaves the same rows. Returns the number of rejected rows, which
    the copy itself counts; an input without any is read once.
    """
    rows = read_csv(spark, source, **dialect)
    if rejects is None:
        fault = {c: F.raise_error(F.concat(F.lit(f"{c} is no {t}: "), F.col(c))) for c, t in casts.items()}
        converted = {
            c: F.when(F.col(c).isNull(), F.lit(None).cast(t)).otherwise(
                F.coalesce(F.col(c).try_cast(t), fault[c].cast(t))
            )
            for c, t in casts.items()
        }
        rows.withColumns(converted).write.mode("overwrite").parquet(target)
        return 0
    names = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in casts.items()]
    judged = rows.withColumn("_failed", F.array_compact(F.array(*names)))
    bad = F.size("_failed") > 0
    seen = Observation()
    counted = judged.observe(seen, F.count_if(bad).alias("rejected"))
    counted.where(~bad).drop("_failed").withColumns(
        {c: F.col(c).try_cast(t) for c, t in casts.items()}
    ).write.mode("overwrite").parquet(target)
    rejected = (seen.get or {}).get("rejected") or 0
    # Only rows to reject cost another look at the input.
    found = judged.where(bad) if rejected else spark.createDataFrame([], judged.schema)
    found.write.mode("overwrite").parquet(rejects)
    return rejected


def save_reference(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a reference table, rows and layout, with rows valid from now on."""
    dated = df.withColumns(
        {
            "valid_from": F.current_timestamp(),
            "valid_till": F.to_timestamp(F.lit(FOREVER)),
        }
    )
    writer = dated.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(identifier(table))


def insert_only(df: DataFrame, table: str) -> None:
    """Append rows marked as processed; the first bad value stops the write."""
    append_into(df.withColumn("status", F.lit("processed")), table)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark can reach."""
    remove_folders(spark, [path])


def merge_files(
    spark: SparkSession, source: str, target: str, file_bytes: int = 256 * 1024 * 1024
) -> int:
    """Rewrite a Parquet folder as files of about ``file_bytes``; returns the bytes read.

    One task per file, so an input below that size becomes one file and a larger one as many
    as it needs.
    """
    rows = spark.read.parquet(source)
    files = rows.select("_metadata.file_path", "_metadata.file_size").distinct()
    size = files.agg(F.sum("file_size")).first()[0] or 0
    rows.repartition(max(1, -(-size // file_bytes))).write.mode("overwrite").parquet(target)
    return size
