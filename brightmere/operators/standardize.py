"""Typed projection of landed rows, split into good and malformed ones."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightmere.functions.calendar import parse_timestamp
from brightmere.operators.topk import first_per_key

# How a target column is made from the source column of the same name:
# None keeps it, a type name casts it, a (type, pattern) pair parses text.
Rule = str | tuple[str, str] | Column | None

PARKING_BAY: dict[str, Rule] = {
    "bay_id": "int",
    "last_edit": ("timestamp", "yyyyMMddHHmmss"),
    "marker_id": None,
    "meter_id": None,
    "rd_seg_dsc": None,
    "rd_seg_id": "int",
    "the_geom": None,
}
SENSOR: dict[str, Rule] = {
    "bay_id": "int",
    "st_marker_id": None,
    "lat": "float",
    "lon": "float",
    "location": None,
    "status": None,
}


def stamp(load_id: object, loaded_on: dt.datetime) -> dict[str, Column]:
    """The two lineage columns of a load."""
    return {
        "load_id": F.lit(load_id),
        "loaded_on": F.to_timestamp(F.lit(loaded_on.isoformat())),
    }


def _apply(name: str, rule: Rule) -> Column:
    source = F.col(f"`{name}`")
    if rule is None:
        return source
    if isinstance(rule, Column):
        return rule.alias(name)
    if isinstance(rule, tuple):
        kind, pattern = rule
        return parse_timestamp(source, pattern).cast(kind).alias(name)
    return source.try_cast(rule).alias(name)


def standardize(
    df: DataFrame,
    spec: dict[str, Rule],
    key: str,
    dedupe_by: list[str] | None,
    load_id: object,
    loaded_on: dt.datetime,
    persist: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Good and malformed rows of ``df``; a row whose typed ``key`` is NULL is malformed.

    Values that do not convert become NULL. With ``dedupe_by`` one row stays per raw key
    (before the conversion), the greatest by those columns as converted and then by all raw
    ones, so a replay keeps the same row. ``persist`` keeps the typed rows for the two writes that
    usually follow; unpersist the good frame when done.
    """
    if dedupe_by is not None:
        typed_order = [_apply(c, spec.get(c)) for c in dedupe_by]
        raw_order = [F.col(f"`{c}`") for c in df.columns if c != key]
        order = [c.desc_nulls_last() for c in [*typed_order, *raw_order]]
        df = first_per_key(df, [key], order)
    typed = df.select(*[_apply(name, rule) for name, rule in spec.items()])
    typed = typed.withColumns(stamp(load_id, loaded_on))
    if persist:
        typed = typed.persist(StorageLevel.MEMORY_AND_DISK)
    return typed.where(F.col(key).isNotNull()), typed.where(F.col(key).isNull())


def standardize_parking_bay(
    df: DataFrame, load_id: object, loaded_on: dt.datetime, persist: bool = False
) -> tuple[DataFrame, DataFrame]:
    return standardize(df, PARKING_BAY, "bay_id", ["last_edit"], load_id, loaded_on, persist)


def standardize_sensordata(
    df: DataFrame, load_id: object, loaded_on: dt.datetime, persist: bool = False
) -> tuple[DataFrame, DataFrame]:
    return standardize(df, SENSOR, "bay_id", None, load_id, loaded_on, persist)
