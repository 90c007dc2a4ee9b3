"""Expectation suites, constraints and their outcome."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the expectations in the result.
EXPECTATIONS = {
    "not_null": "expect_column_values_to_not_be_null",
    "between": "expect_column_values_to_be_between",
    "type": "expect_column_values_to_be_of_type",
}


class QualityError(RuntimeError):
    """A suite that had to pass did not."""


@dataclass(frozen=True)
class Check:
    """One expectation on a column: ``not_null``, ``between`` (min, max) or ``type`` (type)."""

    kind: str
    column: str
    args: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{EXPECTATIONS[self.kind]}_on_{self.column}"

    def unexpected(self, df: DataFrame) -> Column:
        """The number of rows against the expectation, as an aggregate of ``df``."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return F.count_if(c.isNull())
        if self.kind == "between":
            # NULL compares to NULL and is not counted.
            return F.count_if((c < self.args["min"]) | (c > self.args["max"]))
        if self.kind == "type":
            fits = df.schema[self.column].dataType.simpleString() == self.args["type"]
            return F.lit(0).cast("bigint") if fits else F.count(F.lit(1))
        raise ValueError(f"unknown expectation {self.kind!r}")

    def describe(self, df: DataFrame) -> str:
        if self.kind == "type":
            return f"{self.args['type']} wanted, {df.schema[self.column].dataType.simpleString()} found"
        return ", ".join(f"{k}={v}" for k, v in self.args.items())


def run_suite(
    df: DataFrame, checks: list[Check], name: str, run_id: str, fail: bool = False
) -> DataFrame:
    """One row per check: (check_name, run_id, expectation, success, unexpected, total, details).

    All checks are columns of a single aggregation, so the data is read once and only the
    checked columns are. With ``fail`` the result is looked at here and a failed check
    raises ``QualityError``; otherwise it is only reported.
    """
    totals = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[check.unexpected(df).alias(f"_{i}") for i, check in enumerate(checks)],
    )
    rows = []
    for i, check in enumerate(checks):
        success = F.col(f"_{i}") == 0
        if check.kind == "type":
            fits = check.args["type"] == df.schema[check.column].dataType.simpleString()
            success = F.lit(fits)
        rows.append(
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(run_id).alias("run_id"),
                F.lit(check.name).alias("expectation"),
                success.alias("success"),
                F.col(f"_{i}").alias("unexpected"),
                F.col("_total").alias("total"),
                F.when(~success, F.lit(check.describe(df))).alias("details"),
            )
        )
    result = totals.select(F.inline(F.array(*rows)))
    if fail:
        failed = [r["expectation"] for r in result.where(~F.col("success")).collect()]
        if failed:
            raise QualityError(f"suite {name!r} failed: {', '.join(failed)}")
    return result


def check_constraints(df: DataFrame, rules: dict[str, Column | str]) -> DataFrame:
    """(rule, violations) per rule, from one pass; a rule that is NULL for a row holds."""
    named = {n: F.expr(r) if isinstance(r, str) else r for n, r in rules.items()}
    totals = df.agg(*[F.count_if(~r).alias(f"_{i}") for i, r in enumerate(named.values())])
    rows = [
        F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("violations"))
        for i, n in enumerate(named)
    ]
    return totals.select(F.inline(F.array(*rows)))


def check_lengths(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Constraint report for text columns with a maximum length."""
    return check_constraints(df, {f"{c}<={n}": F.length(F.col(c)) <= n for c, n in limits.items()})


# Severities that tell of a finished suite.
SEVERITY = {1: "success", 3: "failed"}


def dq_status(traces: DataFrame, check_names: list[str]) -> DataFrame:
    """(status, check_name, run_id, details, timestamp) of logged suite outcomes.

    ``traces`` has message, check_name, severity, run_id, details and timestamp; only
    finished suites of a named check with a run id count.
    """
    status = F.when(F.col("severity") == 1, SEVERITY[1]).otherwise(SEVERITY[3])
    return traces.where(
        (F.col("message") == "verifychecks")
        & F.col("check_name").isin(check_names)
        & F.col("severity").isin(*SEVERITY)
        & (F.coalesce(F.col("run_id"), F.lit("")) != "")
    ).select(status.alias("status"), "check_name", "run_id", "details", "timestamp")


def dq_status_counts(traces: DataFrame, check_names: list[str]) -> DataFrame:
    return dq_status(traces, check_names).groupBy("status").count()
