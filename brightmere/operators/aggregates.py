"""Counts, histograms, time-binned aggregates and comparisons of totals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightmere.operators.quantiles import quantiles


def _per_column(df: DataFrame, name: str, of: Callable[[Column], Column]) -> DataFrame:
    """One row per column, from a single pass over the input."""
    totals = df.agg(*[of(F.col(f"`{c}`")).alias(c) for c in df.columns])
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(name)) for c in df.columns
    ]
    return totals.select(F.inline(F.array(*entries)))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column."""
    return _per_column(df, "nulls", lambda c: F.count_if(c.isNull()))


def nonnull_counts(df: DataFrame) -> DataFrame:
    """(column, values) for every column."""
    return _per_column(df, "values", F.count)


def dup_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over the column's range: (bin, low, high, count, share).

    The range is found by a first pass of two numbers. The top edge belongs to the last bin.
    """
    low, high, total = df.select(
        F.min(col).cast("double"), F.max(col).cast("double"), F.count(col)
    ).first()
    if not total:
        return df.sparkSession.createDataFrame(
            [], "bin BIGINT, low DOUBLE, high DOUBLE, count BIGINT, share DOUBLE"
        )
    width = (high - low) / bins
    number = F.lit(1) if width == 0 else F.least(
        F.width_bucket(F.col(col), F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins)
    )
    counted = (
        df.where(F.col(col).isNotNull())
        .groupBy(number.cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counted.select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("low"),
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("high"),
        "count",
        (F.col("count") / F.lit(total)).alias("share"),
    )


def bin_quantiles(
    df: DataFrame,
    ts: str,
    width: str,
    keys: list[str],
    values: list[str],
    qs: list[float],
    exact: bool = True,
    late: str | None = None,
) -> DataFrame:
    """(time_bin, keys, an array of quantiles per value). On a stream they are sketched.

    A row without a time is in no bin.
    """
    if df.isStreaming:
        wanted = F.array(*[F.lit(float(q)) for q in qs])
        found = [F.percentile_approx(v, wanted).alias(v) for v in values]
        return _stream_bins(df, ts, width, keys, late, found)
    binned = df.withColumn("time_bin", F.window(ts, width).getField("start"))
    return quantiles(binned, ["time_bin", *keys], values, qs, exact)


def _stream_bins(
    df: DataFrame, ts: str, width: str, keys: list[str], late: str | None, found: list[Column]
) -> DataFrame:
    """Windows of a stream, each given out once its watermark (``late``, or one bin) has passed."""
    grouped = df.withWatermark(ts, late or width).groupBy(F.window(ts, width).alias("_w"), *keys)
    result = grouped.agg(*found)
    rest = [c for c in result.columns if c not in ("_w", *keys)]
    return result.select(F.col("_w.start").alias("time_bin"), *keys, *rest)


def bin_aggregate(
    df: DataFrame,
    ts: str,
    width: str,
    keys: list[str],
    kind: str,
    value: str | None = None,
    q: list[float] | None = None,
    exact: bool = True,
    late: str | None = None,
) -> DataFrame:
    """One aggregate per time bin and keys, as column ``value`` (``quantiles`` for quantiles).

    ``kind`` is count, sum, min, max, avg, delta (max - min, the growth of a counter),
    dcount (distinct values) or quantile. A row without a time is in no bin. On a stream the bins are windows under a
    watermark, and quantiles and distinct counts are the sketched ones.
    """
    if kind == "quantile":
        found = bin_quantiles(df, ts, width, keys, [value], q, exact, late)
        return found.withColumnRenamed(value, "quantiles")
    if df.isStreaming:
        return _stream_bins(df, ts, width, keys, late, [_aggregate(kind, value, False).alias("value")])
    time_bin = F.window(ts, width).getField("start").alias("time_bin")
    return df.groupBy(time_bin, *keys).agg(_aggregate(kind, value, exact).alias("value"))


def _aggregate(kind: str, value: str | None, exact: bool) -> Column:
    if kind == "count":
        return F.count(F.lit(1) if value is None else F.col(value))
    if kind == "delta":
        return F.max(value) - F.min(value)
    if kind == "dcount":
        return F.countDistinct(value) if exact else F.approx_count_distinct(value)
    if kind in ("sum", "min", "max", "avg"):
        return getattr(F, kind)(value)
    raise ValueError(f"unknown kind {kind!r}")


def counter_delta(df: DataFrame, ts: str, width: str, keys: list[str], value: str) -> DataFrame:
    """Growth of a counter per bin: one grouping instead of joining its maxima to its minima."""
    return bin_aggregate(df, ts, width, keys, "delta", value)


def metric_ratio(
    df: DataFrame,
    numerator: str,
    denominator: str,
    keys: list[str],
    ts: str,
    name: str = "name",
    value: str = "value",
    scale: float = 1.0,
) -> DataFrame:
    """Percentage of one metric in another at the same instant: (keys, ts, ratio).

    The two samples of an instant meet in one grouping, not in a join; of repeated
    samples the largest counts. A zero denominator gives NULL.
    """
    is_top, is_base = text_contains(F.col(name), numerator), text_contains(F.col(name), denominator)
    paired = df.where(is_top | is_base).groupBy(*keys, ts).agg(
        F.max(F.when(is_top, F.col(value).cast("double") / scale)).alias("_top"),
        F.max(F.when(is_base, F.col(value).cast("double"))).alias("_base"),
    )
    return paired.where(F.col("_top").isNotNull() & F.col("_base").isNotNull()).select(
        *keys, ts, F.try_divide(F.col("_top") * 100, F.col("_base")).alias("ratio")
    )


def text_contains(text: Column, part: str) -> Column:
    """Whether ``text`` contains ``part``, in any case."""
    return F.lower(text).contains(part.lower())


# Weight of each permission and the text of each sum.
WEIGHTS = {"read": 4, "write": 2, "execute": 1}
RIGHTS = {
    0: "---", 1: "--x", 2: "-w-", 3: "-wx", 4: "r--", 5: "r-x", 6: "rw-", 7: "rwx",
}


def permission_entries(config: DataFrame, prefix: str = "") -> DataFrame:
    """(path, group, type): one row per granted type of nested permission records."""
    records = config.select(F.explode("datalakeProperties").alias("p"))
    grants = records.select(
        F.concat(F.lit(prefix), F.col("p.year"), F.lit("/"), F.col("p.month"), F.lit("/")).alias("path"),
        F.explode("p.aclPermissions").alias("grant"),
    )
    return grants.select("path", F.explode("grant.groups").alias("group"), F.col("grant.type").alias("type"))


def effective_permissions(config: DataFrame, prefix: str = "") -> DataFrame:
    """(path, group, weight, rights) summed over the entries with a known type."""
    entries = permission_entries(config, prefix)
    weight = F.lit(0)
    for kind, value in WEIGHTS.items():
        weight = F.when(F.col("type") == kind, value).otherwise(weight)
    rights = F.create_map(*[F.lit(x) for pair in RIGHTS.items() for x in pair])
    summed = (
        entries.where(F.col("type").isin(*WEIGHTS))
        .groupBy("path", "group")
        .agg(F.sum(weight).cast("int").alias("weight"))
    )
    return summed.withColumn("rights", F.try_element_at(rights, F.col("weight")))


def permission_errors(config: DataFrame, known_groups: DataFrame, prefix: str = "") -> DataFrame:
    """(path, group, error) for entries with an unknown type or an unknown group."""
    entries = permission_entries(config, prefix)
    bad_type = entries.where(~F.col("type").isin(*WEIGHTS) | F.col("type").isNull()).select(
        "path", "group", F.concat(F.lit("unknown type "), F.coalesce("type", F.lit("NULL"))).alias("error")
    )
    bad_group = (
        entries.select("path", "group")
        .distinct()
        .join(known_groups.select("group").distinct(), "group", "left_anti")
        .select("path", "group", F.lit("unknown group").alias("error"))
    )
    return bad_type.unionByName(bad_group)


def check_permissions(config: DataFrame, known_groups: DataFrame) -> None:
    """Raise one error that lists every faulty entry of the configuration."""
    errors = permission_errors(config, known_groups).orderBy("path", "group", "error").collect()
    if errors:
        listed = "; ".join(f"{r['path']} {r['group']}: {r['error']}" for r in errors)
        raise ValueError(f"{len(errors)} faulty permission entries: {listed}")


def reconcile(incoming: DataFrame, outgoing: DataFrame, count: str) -> DataFrame:
    """One row: both totals and whether nothing was lost (incoming <= outgoing)."""
    sides = incoming.select(F.lit("in").alias("side"), F.col(count).alias("n")).unionByName(
        outgoing.select(F.lit("out").alias("side"), F.col(count).alias("n"))
    )
    totals = sides.agg(
        F.coalesce(F.sum(F.when(F.col("side") == "in", F.col("n"))), F.lit(0)).alias("incoming"),
        F.coalesce(F.sum(F.when(F.col("side") == "out", F.col("n"))), F.lit(0)).alias("outgoing"),
    )
    return totals.withColumn("complete", F.col("incoming") <= F.col("outgoing"))
