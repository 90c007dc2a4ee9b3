"""Database reads and writes through Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    isolation: str | None = None,
) -> dict[str, str]:
    """Options for one table or one pushed-down query.

    ``partition`` is (column, lower, upper, parts). Without it the database sends
    everything through a single connection and task, so a large table needs it;
    Spark accepts it for a table only, so a query is wrapped as a derived table.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url}
    if query is not None and partition is None:
        options["query"] = query
    else:
        options["dbtable"] = table if table is not None else f"({query}) source"
    if partition is not None:
        column, lower, upper, parts = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    if isolation is not None:
        options["isolationLevel"] = isolation
    return options


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()


def append_jdbc(df: DataFrame, url: str, table: str, batch: int = 10_000) -> None:
    """Append to a database table; each task writes its rows in batches."""
    (
        df.write.format("jdbc")
        .options(**jdbc_options(url, table=table))
        .option("batchsize", str(batch))
        .mode("append")
        .save()
    )
