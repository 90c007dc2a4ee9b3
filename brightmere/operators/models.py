"""Demand models on Spark's ML library."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightmere.operators import boosting

# Parameters of the boosted trees.
DEPTH, ROUNDS, RATE, SEED = 3, 100, 0.1, 13


def train_demand(
    df: DataFrame,
    label: str = "demand",
    family: str = "gbt",
    rounds: int = ROUNDS,
    features: list[str] | None = None,
) -> PipelineModel | boosting.PoissonTrees:
    """Fit demand on every other column.

    ``gbt`` is boosted trees on squared loss, ``poisson`` a log-linear Poisson model, both of
    Spark's library; ``poisson_trees`` are boosted trees with the Poisson objective. Without
    rows to learn from the model stays at its start: no tree, coefficients of zero.
    """
    inputs = features or [c for c in df.columns if c != label]
    if family == "poisson_trees":
        return boosting.fit(df, label, inputs, rounds, DEPTH, RATE)
    assemble = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")
    common = {"featuresCol": "features", "labelCol": label, "predictionCol": "prediction"}
    if family == "gbt":
        model, start = GBTRegressor(maxDepth=DEPTH, maxIter=rounds, stepSize=RATE, seed=SEED, **common), 0.0
    elif family == "poisson":
        model, start = GeneralizedLinearRegression(family="poisson", link="log", regParam=1e-6, **common), 1.0
    else:
        raise ValueError(f"family is gbt, poisson or poisson_trees, not {family!r}")
    if df.isEmpty():
        return Pipeline(stages=[SQLTransformer(statement=f"SELECT *, {start}D AS prediction FROM __THIS__")]).fit(df)
    return Pipeline(stages=[assemble, model]).fit(df)


def score(model: PipelineModel | boosting.PoissonTrees, df: DataFrame) -> DataFrame:
    """``df`` with the column ``prediction``."""
    return model.transform(df).drop("features")


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row: rows, mae, mse, rmse and r2, from one pass.

    R² needs the spread around the mean; that is the population variance, which Spark
    combines from partial means rather than from sums of squares.
    """
    error = F.col(y).cast("double") - F.col(yhat).cast("double")
    totals = df.where(error.isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(F.col(y).cast("double")).alias("_spread"),
    )
    return totals.select(
        "rows",
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("_spread"))).alias("r2"),
    )
