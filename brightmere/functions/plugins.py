"""Named transforms with one contract: ``transform(spark, df, config) -> df``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightmere.functions.privacy import anonymize
from brightmere.functions.scalars import row_md5

Transform = Callable[[SparkSession, DataFrame, dict], DataFrame]
_TRANSFORMS: dict[str, Transform] = {}


def plugin(name: str) -> Callable[[Transform], Transform]:
    """Register a transform; only registered names can run."""

    def add(transform: Transform) -> Transform:
        if name in _TRANSFORMS:
            raise ValueError(f"transform {name!r} exists already")
        _TRANSFORMS[name] = transform
        return transform

    return add


def names() -> list[str]:
    return sorted(_TRANSFORMS)


def run_plugin(
    spark: SparkSession, name: str, df: DataFrame, config: dict, target: str | None = None
) -> DataFrame:
    """Apply the transform ``name``; with ``target`` also create or append that table."""
    from brightmere.operators.load import create_or_append

    if name not in _TRANSFORMS:
        raise KeyError(f"no transform {name!r}; there are {names()}")
    result = _TRANSFORMS[name](spark, df, config)
    if target is not None:
        create_or_append(result, target, config.get("path"))
    return result


@plugin("md5")
def _md5(spark: SparkSession, df: DataFrame, config: dict) -> DataFrame:
    return row_md5(df, config.get("columns"), config.get("null_token"))


@plugin("data_filter")
def _data_filter(spark: SparkSession, df: DataFrame, config: dict) -> DataFrame:
    return df.where(F.col(config["key_col"]).isin(list(config["filter_criteria"])))


@plugin("anonymize")
def _anonymize(spark: SparkSession, df: DataFrame, config: dict) -> DataFrame:
    return anonymize(df, config["column"])


@plugin("add_literal")
def _add_literal(spark: SparkSession, df: DataFrame, config: dict) -> DataFrame:
    return df.withColumn(config["name"], F.lit(config["value"]))
