"""Look-ups, reference checks, hierarchies and paths. Equality joins only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightmere.session import remove_folders, scratch


def enrich(df: DataFrame, ref: DataFrame, on: str | list[str]) -> DataFrame:
    """``df`` with the columns of a reference table; every row of ``df`` stays."""
    return df.join(ref, on, "left")


def only_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; the key list is reduced first."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of ``child`` whose foreign key (child column -> parent column) has no parent.

    As in a database, a key with a NULL part refers to nothing and is no orphan.
    """
    given = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    ids = parent.select(*[F.col(p).alias(c) for c, p in keys.items()]).distinct()
    return child.where(given).join(ids, list(keys), "left_anti")


def parents(df: DataFrame, id: str, parent: str, name: str) -> DataFrame:
    """(id, name, parent, parent_name) for the rows that have a parent."""
    up = df.select(F.col(id).alias("_up"), F.col(name).alias("parent_name"))
    return df.join(up, F.col(parent) == F.col("_up")).select(id, name, parent, "parent_name")


def hierarchy(df: DataFrame, id: str, parent: str, name: str) -> DataFrame:
    """Every row that a root (NULL parent) leads to, below the roots: (id, name, parent,
    parent_name, level), as recursion with UNION ALL gives it: a row appears once below each
    appearance of its parent, so an id with several parents leads on from each of its levels.

    One join per level, however deep the table is. Each level is written to the shared folder and
    read back, so a level neither repeats the joins above it nor depends on an executor that held
    them. Levels meet by sorted shuffles: the size of a compressed file says little about that of
    its rows in the driver's memory, which a broadcast would fill. Only ids on a cycle that hangs
    on a root (or between two such) lead on from none but the first level that reaches them, which
    brings every table to an end. Rows on a cycle alone are reached by no root.
    """
    spark = df.sparkSession
    path = scratch(spark, "hierarchy")
    rows = df.select(F.col(id).alias("id"), F.col(name).alias("name"), F.col(parent).alias("parent"))
    narrow = spark.read.schema(rows.schema)
    rows.write.parquet(f"{path}/nodes")
    nodes = narrow.parquet(f"{path}/nodes")
    # Where every id has one row, no cycle hangs on a root.
    repeated = not nodes.groupBy("id").count().where("count > 1").isEmpty()
    turning = on_cycles(nodes.select("id", "parent")) if repeated else None
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    known = spark.read.schema(f"id {types['id']}, name {types['name']}")
    path = f"{path}/levels"
    nodes.where(F.col("parent").isNull()).select("id", "name").write.parquet(f"{path}/level=0")
    level = 0
    while True:
        above = known.parquet(f"{path}/level={level}").select(
            F.col("id").alias("_up"), F.col("name").alias("parent_name")
        )
        if above.isEmpty():
            break
        if turning is not None and level:
            reached = known.parquet(*[f"{path}/level={n}" for n in range(level)])
            spent = reached.join(turning, "id", "left_semi").select(F.col("id").alias("_up"))
            above = above.join(spent.hint("merge"), "_up", "left_anti")
        level += 1
        children = nodes.join(above.hint("merge"), F.col("parent") == F.col("_up")).select(
            "id", "name", "parent", "parent_name"
        )
        children.write.parquet(f"{path}/level={level}")
    layout = (
        f"id {types['id']}, name {types['name']}, parent {types['parent']}, "
        f"parent_name {types['name']}, level INT"
    )
    return (
        spark.read.schema(layout)
        .parquet(path)
        .where(F.col("level") > 0)
        .select(
            F.col("id").alias(id),
            F.col("name").alias(name),
            F.col("parent").alias(parent),
            F.col("parent_name"),
            F.col("level"),
        )
    )


def on_cycles(links: DataFrame) -> DataFrame | None:
    """(id) of ``links`` (id, parent) that lie on a cycle or between two; None if there is none.

    Peels the links: round after round those whose parent has no open parent go, then those whose
    id has no open child. What stays goes round. The number of rounds is that of the levels; each
    round is written to the shared folder, which the next one reads.
    """
    spark = links.sparkSession
    path = scratch(spark, "peeled")
    left = links.where(F.col("id").isNotNull() & F.col("parent").isNotNull()).distinct()
    step, size = 0, -1
    for here, there in (("parent", "id"), ("id", "parent")):
        while True:
            left.write.parquet(f"{path}/{step}")
            left = spark.read.schema(left.schema).parquet(f"{path}/{step}")
            step, before, size = step + 1, size, left.count()
            if size in (0, before):
                break
            open_ = left.select(F.col(there).alias(here)).distinct()
            left = left.join(open_, here, "left_semi").select("id", "parent")
        if not size:
            break
    remove_folders(spark, [f"{path}/{n}" for n in range(step - 1)])
    return left.select("id").union(left.select("parent")).distinct() if size else None


def graph_path(nodes: list[DataFrame], edges: list[DataFrame], ids: list[str]) -> DataFrame:
    """Rows node-edge-node-...-node of a graph.

    ``nodes`` has one frame per step (its id column named in ``ids``, other columns are
    carried along and must differ between steps); ``edges`` has one frame ``(src, dst)``
    between each two steps. Parallel edges give parallel paths.
    """
    path = nodes[0]
    for step, edge in enumerate(edges):
        links = edge.select(F.col("src").alias(ids[step]), F.col("dst").alias(ids[step + 1]))
        path = path.join(links, ids[step]).join(nodes[step + 1], ids[step + 1])
    return path


def correlate(
    start: DataFrame, end: DataFrame, on: list[str], ts: str, keep: list[str] = ()
) -> DataFrame:
    """End events with the first start event of their key (one without a time comes last).

    From the start side come ``ts`` as ``start_<ts>`` and the columns ``keep``, prefixed
    ``start_``. Starts are reduced to one row per key before the join, so repeated starts
    do not multiply the ends; ends without a start drop out.
    """
    carried = [c for c in [ts, *keep] if c not in on]
    untimed = F.col(ts).isNull().alias("_untimed")
    first = start.groupBy(*on).agg(F.min(F.struct(untimed, *carried)).alias("_s"))
    first = first.select(*on, *[F.col(f"_s.{c}").alias(f"start_{c}") for c in carried])
    return end.join(first, on)


def calendar_join(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """Inner join on calendar columns (left name -> right name), keeping the left names."""
    renamed = right.withColumnsRenamed({r: l for l, r in on.items()})
    return left.join(renamed, list(on))
