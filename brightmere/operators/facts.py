"""Star-schema facts: business keys replaced by dimension keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightmere.functions.scalars import EMPTY_UUID
from brightmere.operators.standardize import stamp

Dimension = tuple[DataFrame, list[str] | dict[str, str], str]


def star_fact(facts: DataFrame, dims: list[Dimension], unknown: str = EMPTY_UUID) -> DataFrame:
    """``facts`` with the surrogate of each dimension, ``unknown`` where none matches.

    A dimension is (frame, keys, surrogate); keys are shared column names or a map from
    fact column to dimension column. Only keys and surrogate of a dimension are read. Small
    dimensions are broadcast by Spark's own size check; for larger ones the fact side is the
    outer side, which adaptive execution may split where one key (or NULL) is frequent.
    """
    for number, (dim, keys, surrogate) in enumerate(dims):
        pairs = keys if isinstance(keys, dict) else {k: k for k in keys}
        lookup = dim.select(
            *[F.col(d).alias(f"_k{number}_{i}") for i, d in enumerate(pairs.values())],
            F.col(surrogate).alias(f"_s{number}"),
        )
        on = [F.col(f) == F.col(f"_k{number}_{i}") for i, f in enumerate(pairs)]
        kept = facts.columns
        facts = facts.join(lookup, on, "left").select(
            *kept, F.coalesce(F.col(f"_s{number}"), F.lit(unknown)).alias(surrogate)
        )
    return facts


def time_of_load(loaded_on: dt.datetime, time_key: str = "until") -> int:
    """Seconds to the next midnight (``until``) or since the last (``since``), whole."""
    midnight = loaded_on.replace(hour=0, minute=0, second=0, microsecond=0)
    if time_key == "since":
        return (loaded_on - midnight) // dt.timedelta(seconds=1)
    if time_key != "until":
        raise ValueError(f"time_key is until or since, not {time_key!r}")
    return (midnight - loaded_on) // dt.timedelta(seconds=1) % 86400


def process_fact_parking(
    sensor: DataFrame,
    dim_bay: DataFrame,
    dim_location: DataFrame,
    dim_marker: DataFrame,
    load_id: object,
    loaded_on: dt.datetime,
    time_key: str = "until",
) -> DataFrame:
    """One fact per sensor row."""
    keyed = star_fact(
        sensor.select("bay_id", "lat", "lon", "st_marker_id", "status"),
        [
            (dim_bay, ["bay_id"], "dim_parking_bay_id"),
            (dim_location, ["lat", "lon"], "dim_location_id"),
            (dim_marker, ["st_marker_id"], "dim_st_marker_id"),
        ],
    )
    return keyed.select(
        F.lit(f"{loaded_on:%Y%m%d}").alias("dim_date_id"),
        F.lit(time_of_load(loaded_on, time_key)).alias("dim_time_id"),
        "dim_parking_bay_id",
        "dim_location_id",
        "dim_st_marker_id",
        "status",
    ).withColumns(stamp(load_id, loaded_on))
