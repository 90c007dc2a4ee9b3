"""Dimension loads that overwrite changed attributes in place."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightmere.functions.scalars import surrogate_key
from brightmere.operators.standardize import stamp


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _conform(incoming: DataFrame, dim: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct incoming rows in the dimension's types (and with one zero)."""
    types = {f.name: f.dataType for f in dim.schema.fields}

    def typed(name: str) -> Column:
        c = F.col(name).cast(types[name])
        if types[name].typeName() in ("float", "double"):
            c = (c + F.lit(0.0)).cast(types[name])
        return c.alias(name)

    return incoming.select(*[typed(c) for c in columns]).distinct()


def scd1_upsert(
    incoming: DataFrame,
    dim: DataFrame,
    keys: list[str],
    attrs: list[str],
    surrogate: str,
    load_id: object,
    loaded_on: dt.datetime,
    key_mode: str = "md5",
    null_keys: str = "ignore",
    duplicates: str = "keep",
) -> DataFrame:
    """The dimension after a load.

    Rows only in ``dim`` stay as they are; keys in both take the incoming attributes and
    keep their surrogate; new keys get one: a repeatable hash of the key (``md5``) or a
    random UUID (``random``, to be written before it is read twice).

    A key with a NULL part never matches. ``null_keys="ignore"`` leaves such incoming rows
    out, ``"append"`` adds them anew at each load.

    ``duplicates="keep"`` is for incoming data that may hold several versions of a key:
    each stays a row. Its two joins keep their large side splittable when one key holds
    many rows. ``"unique"`` is for incoming data known to hold one row per key, and needs a
    single full outer join.
    """
    if key_mode not in ("md5", "random"):
        raise ValueError(f"key_mode is md5 or random, not {key_mode!r}")
    if null_keys not in ("ignore", "append"):
        raise ValueError(f"null_keys is ignore or append, not {null_keys!r}")
    if duplicates not in ("keep", "unique"):
        raise ValueError(f"duplicates is keep or unique, not {duplicates!r}")

    columns = [surrogate, *keys, *attrs, "load_id", "loaded_on"]
    marks = stamp(load_id, loaded_on)
    types = {f.name: f.dataType for f in dim.schema.fields}
    load_stamp = marks["load_id"].cast(types["load_id"])
    time_stamp = marks["loaded_on"].cast(types["loaded_on"])

    def new_id(*parts: Column) -> Column:
        return F.uuid() if key_mode == "random" else surrogate_key(*parts)

    fresh = _conform(incoming, dim, [*keys, *attrs])
    keyed = fresh.where(_all([F.col(k).isNotNull() for k in keys]))
    old = dim.select(*columns)

    if duplicates == "unique":
        result = _full_outer(keyed, old, keys, attrs, surrogate, new_id, load_stamp, time_stamp)
    else:
        ids = old.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(surrogate))
        same = _all([F.col(k) == F.col(f"_{k}") for k in keys])
        loaded = keyed.join(ids, same, "left").select(
            F.coalesce(F.col(surrogate), new_id(*[F.col(k) for k in keys])).alias(surrogate),
            *keys,
            *attrs,
            load_stamp.alias("load_id"),
            time_stamp.alias("loaded_on"),
        )
        kept = old.join(keyed.select(*keys).distinct(), keys, "left_anti").select(*columns)
        result = kept.unionByName(loaded)

    if null_keys == "append":
        keyless = fresh.where(~_all([F.col(k).isNotNull() for k in keys]))
        added = keyless.select(
            new_id(*[F.col(k) for k in keys], load_stamp).alias(surrogate),
            *keys,
            *attrs,
            load_stamp.alias("load_id"),
            time_stamp.alias("loaded_on"),
        )
        result = result.unionByName(added)
    return result


def _full_outer(keyed, old, keys, attrs, surrogate, new_id, load_stamp, time_stamp) -> DataFrame:
    arrived = keyed.withColumn("_arrived", F.lit(True)).alias("i")
    same = _all([F.col(f"i.{k}") == F.col(f"d.{k}") for k in keys])
    is_in = F.col("i._arrived").isNotNull()
    return arrived.join(old.alias("d"), same, "full_outer").select(
        F.coalesce(F.col(f"d.{surrogate}"), new_id(*[F.col(f"i.{k}") for k in keys])).alias(surrogate),
        *[F.coalesce(F.col(f"i.{k}"), F.col(f"d.{k}")).alias(k) for k in keys],
        *[F.when(is_in, F.col(f"i.{a}")).otherwise(F.col(f"d.{a}")).alias(a) for a in attrs],
        F.when(is_in, load_stamp).otherwise(F.col("d.load_id")).alias("load_id"),
        F.when(is_in, time_stamp).otherwise(F.col("d.loaded_on")).alias("loaded_on"),
    )


def process_dim_parking_bay(
    parkingbay: DataFrame, dim: DataFrame, load_id: object, loaded_on: dt.datetime, **options
) -> DataFrame:
    attrs = ["marker_id", "meter_id", "rd_seg_dsc", "rd_seg_id"]
    # Standardised bays hold one row per raw number, so few can share a converted one.
    options = {"duplicates": "unique", **options}
    return scd1_upsert(
        parkingbay, dim, ["bay_id"], attrs, "dim_parking_bay_id", load_id, loaded_on, **options
    )


def process_dim_location(
    sensor: DataFrame, dim: DataFrame, load_id: object, loaded_on: dt.datetime, **options
) -> DataFrame:
    options = {"duplicates": "unique", **options}
    return scd1_upsert(
        sensor, dim, ["lat", "lon"], [], "dim_location_id", load_id, loaded_on, **options
    )


def process_dim_st_marker(
    sensor: DataFrame, dim: DataFrame, load_id: object, loaded_on: dt.datetime, **options
) -> DataFrame:
    options = {"duplicates": "unique", **options}
    return scd1_upsert(
        sensor, dim, ["st_marker_id"], [], "dim_st_marker_id", load_id, loaded_on, **options
    )
