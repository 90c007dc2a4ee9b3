"""Demand features: cleansing, hourly demand, weather, scaling, encoding and feature sets."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

from brightmere.functions.calendar import calendar_parts, hour_id
from brightmere.operators.joins import calendar_join
from brightmere.operators.load import append_path
from brightmere.session import scratch

# Zones without a place, and the renamed weather columns.
UNKNOWN_ZONES = [264, 265]
WEATHER_COLUMNS = {
    "temperature_2m (°C)": "temperature_2m_c",
    "precipitation (mm)": "precipitation_mm",
    "cloud_cover (%)": "cloudcover_percentage",
    "wind_speed_10m (km/h)": "windspeed_10m_km_per_hour",
}
SCALED = {
    "temperature_2m_c": "scaled_temperature",
    "windspeed_10m_km_per_hour": "scaled_windspeed",
    "precipitation_mm": "scaled_precipitation",
    "cloudcover_percentage": "scaled_cloudcover",
}
DEMAND_KEYS = ["hour_pickup", "day_pickup", "weekday_pickup", "month_pickup"]
WEATHER_JOIN = {"month_pickup": "month", "day_pickup": "day", "hour_pickup": "hour"}


def without(df: DataFrame, columns: list[str], codes: list) -> DataFrame:
    """Rows where none of the columns holds a sentinel code; NULL is not one."""
    for c in columns:
        df = df.where(~F.col(c).isin(codes) | F.col(c).isNull())
    return df


def cleanse_trips(trips: DataFrame) -> DataFrame:
    return without(
        trips.dropna(subset=["passenger_count"]), ["PULocationID", "DOLocationID"], UNKNOWN_ZONES
    )


def cleanse_weather(weather: DataFrame) -> DataFrame:
    named = weather.withColumnsRenamed(WEATHER_COLUMNS)
    return named.dropna(subset=["temperature_2m_c"]).select("time", *WEATHER_COLUMNS.values())


def cleanse_zones(zones: DataFrame) -> DataFrame:
    return zones.dropna(subset=["service_zone"])


def ordinal_encode(df: DataFrame, col: str, order_by: str, name: str = "code") -> DataFrame:
    """(col, code): the distinct values numbered from 0 by where ``order_by`` first shows them.

    The values are reduced first. Their numbers come from a range-partitioned sort: a count
    per partition gives each partition its first number, so no task sees all the values.
    """
    firsts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.min(order_by).alias("_first"))
    return _numbered(firsts, ["_first", col], name).select(col, name)


def _numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows from 0 in a total order."""
    spark = df.sparkSession
    path = scratch(spark, "ranked")
    # Written once: the partition of a row must not change between counting and numbering.
    df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    per_part = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return rows.join(starts, "_part").select(
        *df.columns, (F.col("_start") + F.row_number().over(inside) - 1).cast("int").alias(name)
    )


def borough_codes(zones: DataFrame) -> DataFrame:
    """(Borough, borough_id) in order of first appearance by ``LocationID``."""
    return ordinal_encode(zones, "Borough", "LocationID", "borough_id")


def demand(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips per hour, day, weekday, month and borough, with the first pickup and the code.

    Trips are counted per zone before they meet the zone table, so a frequent zone is
    reduced in the tasks that read it. Trips without a borough drop out.
    """
    parts = calendar_parts(trips, "tpep_pickup_datetime", "_pickup")
    per_zone = parts.groupBy(*DEMAND_KEYS, F.col("PULocationID").alias("LocationID")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("tpep_pickup_datetime").alias("_first")
    )
    named = zones.select("LocationID", "Borough").where(F.col("Borough").isNotNull())
    return (
        per_zone.join(named, "LocationID")
        .groupBy(*DEMAND_KEYS, "Borough")
        .agg(F.sum("_n").alias("demand"), F.min("_first").alias("pickup_timestamp"))
        .join(borough_codes(zones), "Borough")
    )


def weather_features(weather: DataFrame) -> DataFrame:
    """Weather by hour with ``time`` parsed, its calendar parts and the id ``yyyyMMddHH``."""
    timed = weather.withColumn("time", F.col("time").try_cast("timestamp_ntz"))
    parts = calendar_parts(timed, "time").drop("weekday")
    return parts.withColumn("id", hour_id(F.col("time")))


def minmax_fit(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with the minimum and maximum of each column."""
    return df.agg(
        *[F.min(c).cast("double").alias(f"{c}_min") for c in cols],
        *[F.max(c).cast("double").alias(f"{c}_max") for c in cols],
    )


def minmax_apply(df: DataFrame, fit: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Add each column scaled by a fit, under a new name; a constant column becomes 0."""
    bounds = fit.first()

    def scaled(c: str) -> Column:
        low, high = bounds[f"{c}_min"], bounds[f"{c}_max"]
        if low is None:
            return F.lit(None).cast("double")
        return (F.col(c) - F.lit(low)) / F.lit(high - low if high > low else 1.0)

    return df.withColumns({name: scaled(c) for c, name in cols.items()})


def training_frame(taxi: DataFrame, weather: DataFrame, year: int) -> DataFrame:
    """Demand with the scaled weather of its hour in ``year``, model columns only."""
    of_year = weather.where(F.col("year") == year)
    scaled = minmax_apply(of_year, minmax_fit(of_year, list(SCALED)), SCALED)
    joined = calendar_join(taxi, scaled.select("month", "day", "hour", *SCALED.values()), WEATHER_JOIN)
    return joined.select("borough_id", *DEMAND_KEYS, *SCALED.values(), "demand")


def split(
    df: DataFrame, keys: list[str], share: float = 0.8, seed: int = 13
) -> tuple[DataFrame, DataFrame]:
    """Two parts, by a hash of the key: a row is in the same part however often it is computed."""
    inside = split_bucket(keys, seed) < int(round(share * 10_000))
    return df.where(inside), df.where(~inside)


def split_bucket(keys: list[str], seed: int) -> Column:
    """A number 0..9999 from the key and the seed."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000


REGISTRY_LAYOUT = """name STRING, version BIGINT, path STRING, format STRING, timestamp_column STRING,
    layout STRING, index_columns ARRAY<STRING>, stage STRING, tags MAP<STRING, STRING>"""


def register(
    spark: SparkSession,
    registry: str,
    name: str,
    path: str,
    layout: StructType,
    timestamp_column: str,
    index_columns: list[str],
    fmt: str = "parquet",
    version: int | None = None,
    stage: str = "Development",
    tags: dict[str, str] | None = None,
) -> int:
    """Add a feature set to the registry folder; returns its version (now, in epoch seconds).

    A version that the set already has is refused, also the one of the present second.
    """
    version = int(time.time()) if version is None else version
    try:
        known = spark.read.schema(REGISTRY_LAYOUT).parquet(registry).where((F.col("name") == name) & (F.col("version") == version))
        if not known.isEmpty():
            raise ValueError(f"feature set {name!r} has a version {version} already")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    row = (
        name, version, path, fmt, timestamp_column, json.dumps(layout.jsonValue()),
        index_columns, stage, tags or {},
    )
    append_path(spark.createDataFrame([row], REGISTRY_LAYOUT).coalesce(1), registry)
    return version


def read_feature_set(
    spark: SparkSession, registry: str, name: str, version: int | None = None
) -> DataFrame:
    """The features of a registered set, in its declared types (the newest by default)."""
    entries = spark.read.schema(REGISTRY_LAYOUT).parquet(registry).where(F.col("name") == name)
    if version is not None:
        entries = entries.where(F.col("version") == version)
    found = entries.orderBy(F.col("version").desc()).first()
    if found is None:
        raise KeyError(f"no feature set {name!r}" + (f" version {version}" if version else ""))
    layout = StructType.fromJson(json.loads(found["layout"]))
    reader = spark.read.schema(layout).format(found["format"])
    if found["format"] == "csv":
        reader = reader.option("header", True)
    return reader.load(found["path"])
