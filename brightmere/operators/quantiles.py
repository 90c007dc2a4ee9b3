"""Exact quantiles of groups of any size, and sketched ones.

The exact form selects ranks. Values are counted and dealt into cells of values, the counts of the
cells tell which of them hold the wanted ranks, and only those are gone through value by value.
It is one lazy plan for groups of all sizes. No step holds a group: counts are sorted and summed
up row by row, and a group of most rows is spread over tasks by its values. Groups go by 128 bits
of hashes of their keys; two of a billion groups share them with a chance below 10^-20.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

# A sketch of this accuracy misplaces a value by at most n / ACCURACY ranks.
ACCURACY = 10_000
# Cells for each doubling of a value.
STEPS = 1 << 9


def quantiles(
    df: DataFrame, keys: list[str], values: list[str], qs: list[float], exact: bool = True, weight: str | None = None
) -> DataFrame:
    """Per group of ``keys``: for each column of ``values`` the array of its values at ``qs``.

    NULLs do not count; a group without values has a NULL array. Exact quantiles interpolate
    between the two neighbouring values. ``exact=False`` gives values of bounded rank error.
    ``weight`` names a column that says how many rows each row stands for.
    """
    if not exact:
        if weight:
            raise ValueError("sketches take no weights")
        wanted = F.array(*[F.lit(float(q)) for q in qs])
        found = [F.percentile_approx(F.col(v).cast("double"), wanted, ACCURACY).alias(v) for v in values]
        return df.groupBy(*keys).agg(*found)
    # Each group has an entry of its own, which carries its keys, so that one without values is not lost.
    given = ", ".join(f"isnull(`{k}`), `{k}`" for k in keys) or "0"
    entries = [f"struct(-1 AS _m, CAST(NULL AS DOUBLE) AS _v, struct({', '.join(f'`{k}`' for k in keys) or '0'}) AS _k)"]
    entries += [f"struct({i} AS _m, CAST(`{v}` AS DOUBLE) AS _v, NULL AS _k)" for i, v in enumerate(values)]
    melted = df.selectExpr(
        f"xxhash64({given}) AS _g",
        f"xxhash64('', {given}) AS _h",
        f"CAST({f'`{weight}`' if weight else 1} AS BIGINT) AS _n",
        f"inline(array({', '.join(entries)}))",
    ).where("_m < 0 OR _v IS NOT NULL")
    counted = melted.groupBy("_g", "_h", "_m", "_k", _cell(F.col("_v")).alias("_p"), "_v").agg(F.sum("_n").alias("_n"))
    near = [f"max(IF({_inside(r)}, _v, NULL)) AS _v{j}{side}" for j, q in enumerate(qs) for side, r in zip("lh", _ranks(q))]
    found = _selected(counted, qs).groupBy("_g", "_h", "_m", "_k").agg(F.max("_total").alias("_total"), *map(F.expr, near))
    between = ", ".join(_between(f"_v{j}l", f"_v{j}h", _place(q)) for j, q in enumerate(qs))
    found = found.withColumn("_q", F.expr(f"array({between})")).groupBy("_g", "_h").agg(
        F.any_value("_k", True).alias("_k"), *[F.expr(f"max(IF(_m = {i}, _q, NULL)) AS _q{i}") for i in range(len(values))]
    )
    return found.select(
        *[F.col("_k")[f"{k}"].alias(k) for k in keys], *[F.col(f"_q{i}").alias(v) for i, v in enumerate(values)]
    )


def _place(q: float, total: str = "_total") -> str:
    """SQL for the place of a quantile among ``total`` values, from 0."""
    return f"(({total} - 1) * {float(q)}D)"


def _ranks(q: float) -> tuple[str, str]:
    """SQL for the ranks next to a quantile's place."""
    return f"floor({_place(q)})", f"ceil({_place(q)})"


def _inside(rank: str) -> str:
    """SQL for whether a rank falls to the _n values after the first _before."""
    return f"{rank} >= _before AND {rank} < _before + _n"


def _between(below: str, above: str, place: str) -> str:
    """SQL for the value at a place between two ranks."""
    mixed = f"(ceil({place}) - {place}) * {below} + ({place} - floor({place})) * {above}"
    return f"IF(floor({place}) = ceil({place}) OR {below} = {above}, {below}, {mixed})"


def _selected(counted: DataFrame, qs: list[float]) -> DataFrame:
    """(_g, _h, _m, _total, _before, _n, _v, _k): the values that the ranks next to the quantiles
    ``qs`` fall on, among the _total values of a measure _m of a group; _before values are smaller.
    ``counted`` has one row (_g, _h, _m, _p, _v, _n, _k) for each different value, with its cell
    and number."""
    path = ["_g", "_h", "_m", "_p"]
    wanted = " OR ".join(sorted({_inside(rank) for q in qs for rank in _ranks(q)}))
    of_group = Window.partitionBy("_g", "_h", "_m")
    # Both the counts of the cells and the look into them read this one shuffle.
    dealt = counted.repartition(*path)
    cells = dealt.groupBy(*path, "_k").agg(F.sum("_n").alias("_n"))
    cells = cells.withColumns({"_total": F.sum("_n").over(of_group), "_before": _earlier(of_group.orderBy("_p"))})
    held = dealt.drop("_k").join(cells.where(wanted).select(*path, "_k", "_total", F.col("_before").alias("_start")), path)
    before = F.col("_start") + _earlier(Window.partitionBy(*path).orderBy("_v"))
    return held.withColumn("_before", before).where(wanted)


def _earlier(order: WindowSpec) -> Column:
    """How many values the rows before this one stand for."""
    return F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _cell(v: Column) -> Column:
    """A whole number that never falls as ``v`` grows: the sign and STEPS cells for each doubling."""
    most = 2_000 * STEPS
    size = F.when(F.abs(v) == F.lit(float("inf")), 2 * most).otherwise(F.floor(F.log2(F.abs(v)) * STEPS) + most)
    signed = F.when(F.isnan(v), 3 * most).when(v > 0, size).when(v < 0, -size).otherwise(0)
    return F.coalesce(signed.cast("bigint"), F.lit(0).cast("bigint"))
