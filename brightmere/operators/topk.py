"""First rows per key, top rows, sorts and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


# Up to this many rows per key Spark cuts the groups before the shuffle by itself.
EARLY_CUT = 1000
SALTS = 64


def _ranked(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key by ``order``.

    The rank filter lets Spark cut every task's rows to ``n`` per key before the shuffle, so
    a key that holds most of the input sends only ``n`` rows per task. For a large ``n``
    that cut does not apply; there the rows of a key are first ranked in salted parts, each
    of which keeps its first ``n``.
    """
    if n > EARLY_CUT:
        # The salt is a hash of the row, so a task that runs again makes the same one.
        hashed = [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(SALTS)))
        df = _ranked(salted, [*keys, "_salt"], order, n).drop("_salt")
    return _ranked(df, keys, order, n)


def latest_per_key(df: DataFrame, key: str, ts: str, n: int = 1, tie: str | None = None) -> DataFrame:
    """The newest ``n`` rows per key; ``tie`` orders rows of one instant."""
    order = [F.col(ts).desc_nulls_last()]
    if tie is not None:
        order.append(F.col(tie).desc_nulls_last())
    return first_per_key(df, [key], order, n)


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a sort; only ``n`` rows per task travel."""
    return df.orderBy(*order).limit(n)


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()
