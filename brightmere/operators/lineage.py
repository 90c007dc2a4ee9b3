"""Which inputs a process turned into which outputs, read off what it really wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brightmere.operators.load import append_path

EDGE_LAYOUT = "input STRING, process STRING, output STRING, load_id STRING"


def record(
    spark: SparkSession, inputs: list[str], outputs: list[str], process: str, load_id: str
) -> DataFrame:
    """One edge per input and output of a process run."""
    edges = [(i, process, o, load_id) for i in inputs for o in outputs]
    return spark.createDataFrame(edges, EDGE_LAYOUT)


def inputs(df: DataFrame) -> list[str]:
    """The tables (by name) and folders or files (by path) that a frame reads, sorted.

    They are the leaves of the analysed plan, so views and cached frames count as what they
    read. Rows made in the program are no input.
    """
    found = set()
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind == "HiveTableRelation":
            found.add(leaf.tableMeta().identifier().unquotedString())
        elif kind == "LogicalRelation" and leaf.catalogTable().isDefined():
            found.add(leaf.catalogTable().get().identifier().unquotedString())
        elif kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = leaf.relation().location().rootPaths()
            found |= {paths.apply(n).toString() for n in range(paths.size())}
        elif kind == "LogicalRelation":
            found.add(leaf.relation().toString())
    return sorted(found)


def write(df: DataFrame, path: str, process: str, load_id: str, log: str, mode: str = "append") -> list[str]:
    """Write rows as Parquet, and then an edge from each input they were read from to ``path``
    to the folder ``log``; returns the inputs. A write that fails leaves no edge."""
    read = inputs(df)
    df.write.mode(mode).parquet(path)
    append_path(record(df.sparkSession, read, [path], process, load_id), log)
    return read
