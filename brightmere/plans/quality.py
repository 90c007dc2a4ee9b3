"""Expectations and constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightmere.operators.quality import (
    Check,
    QualityError,
    check_constraints,
    check_lengths,
    dq_status,
    dq_status_counts,
    run_suite,
)
from brightmere.plans.registry import query

FULL, PART = "expect_column_values_to_not_be_null_on_", "expect_column_values_to_be_between_on_"
KIND = "expect_column_values_to_be_of_type_on_"


def _trips(t):
    """Events with gaps: small values and errors have no passenger count or flag."""
    return t.events.select(
        F.when(F.col("value") >= 1, F.col("value")).alias("passenger_count"),
        F.col("value").alias("trip_distance"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("store_and_fwd_flag"),
        F.col("user_id").alias("payment_type"),
    )


def _row(expectation: str, unexpected: str, details: str, suite: str) -> str:
    return f"""SELECT '{suite}' AS check_name, 'run-1' AS run_id, '{expectation}' AS expectation,
                      u = 0 AS success, u AS unexpected, n AS total, CASE WHEN u > 0 THEN '{details}' END AS details
               FROM (SELECT ({unexpected})::BIGINT AS u, count(*) AS n FROM events)"""


@query(
    "dq_not_null",
    _row(FULL + "passenger_count", "count(*) FILTER (value < 1)", "", "nulls")
    + " UNION ALL "
    + _row(FULL + "trip_distance", "0", "", "nulls"),
)
def dq_not_null(spark, t):
    checks = [Check("not_null", "passenger_count"), Check("not_null", "trip_distance")]
    return run_suite(_trips(t), checks, "nulls", "run-1")


@query(
    "dq_between",
    _row(PART + "passenger_count", "count(*) FILTER (value >= 1 AND value > 10)", "min=0, max=10", "range"),
)
def dq_between(spark, t):
    """Missing counts pass."""
    return run_suite(_trips(t), [Check("between", "passenger_count", {"min": 0, "max": 10})], "range", "run-1")


@query(
    "dq_type",
    _row(KIND + "store_and_fwd_flag", "0", "", "types")
    + " UNION ALL "
    + _row(KIND + "payment_type", "count(*)", "int wanted, bigint found", "types"),
)
def dq_type(spark, t):
    checks = [
        Check("type", "store_and_fwd_flag", {"type": "string"}),
        Check("type", "payment_type", {"type": "int"}),
    ]
    return run_suite(_trips(t), checks, "types", "run-1")


SUITE = [
    Check("between", "passenger_count", {"min": 0, "max": 10}),
    Check("not_null", "passenger_count"),
    Check("not_null", "trip_distance"),
    Check("type", "store_and_fwd_flag", {"type": "string"}),
    Check("not_null", "store_and_fwd_flag"),
    Check("type", "payment_type", {"type": "int"}),
]


@query(
    "dq_suite",
    " UNION ALL ".join(
        [
            _row(PART + "passenger_count", "count(*) FILTER (value > 10)", "min=0, max=10", "trips"),
            _row(FULL + "passenger_count", "count(*) FILTER (value < 1)", "", "trips"),
            _row(FULL + "trip_distance", "0", "", "trips"),
            _row(KIND + "store_and_fwd_flag", "0", "", "trips"),
            _row(FULL + "store_and_fwd_flag", "count(*) FILTER (event_type = 'error')", "", "trips"),
            _row(KIND + "payment_type", "count(*)", "int wanted, bigint found", "trips"),
        ]
    ),
)
def dq_suite(spark, t):
    return run_suite(_trips(t), SUITE, "trips", "run-1")


@query(
    "dq_policy",
    """SELECT 'fail' AS policy, count(*) FILTER (value < 1) > 0 AS raised FROM events
       UNION ALL SELECT 'log', false""",
)
def dq_policy(spark, t):
    """A failing suite raises under one policy and only reports under the other."""
    checks = [Check("not_null", "passenger_count")]
    outcome = []
    for policy, fail in (("fail", True), ("log", False)):
        try:
            run_suite(_trips(t), checks, "trips", "run-1", fail=fail)
            outcome.append((policy, False))
        except QualityError:
            outcome.append((policy, True))
    return spark.createDataFrame(outcome, "policy STRING, raised BOOLEAN")


@query(
    "dq_constraints",
    """SELECT rule, violations FROM (
         SELECT 'quantity' AS rule, count(*) FILTER (NOT l_quantity > 10) AS violations FROM lineitem
         UNION ALL SELECT 'price', count(*) FILTER (NOT l_extendedprice >= 0) FROM lineitem
         UNION ALL SELECT 'discount', count(*) FILTER (NOT l_discount >= 0.01) FROM lineitem
         UNION ALL SELECT 'status', count(*) FILTER (NOT l_linenumber BETWEEN 0 AND 6) FROM lineitem
         UNION ALL SELECT 'ship date', count(*) FILTER (l_returnflag <> 'R' AND NOT l_shipdate >= TIMESTAMP '1996-01-01') FROM lineitem)""",
)
def dq_constraints(spark, t):
    """Row rules; returned lines have no ship date, which passes."""
    shipped = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    return check_constraints(
        t.lineitem,
        {
            "quantity": "l_quantity > 10",
            "price": "l_extendedprice >= 0",
            "discount": "l_discount >= 0.01D",
            "status": "l_linenumber BETWEEN 0 AND 6",
            "ship date": shipped >= F.lit("1996-01-01").cast("timestamp_ntz"),
        },
    )


@query(
    "dq_lengths",
    """SELECT 'p_name<=10' AS rule, count(*) FILTER (length(p_name) > 10) AS violations FROM part
       UNION ALL SELECT 'p_brand<=15', count(*) FILTER (length(p_brand) > 15) FROM part""",
)
def dq_lengths(spark, t):
    return check_lengths(t.part, {"p_name": 10, "p_brand": 15})


def _traces(t):
    """Events as suite outcomes: errors failed, views and purchases went well, sign-ups only inform."""
    kind = F.col("event_type")
    severity = F.when(kind == "error", 3).when(kind == "signup", 2).otherwise(1)
    return t.events.select(
        F.when(F.col("event_type") == "click", "other").otherwise("verifychecks").alias("message"),
        F.when(F.col("event_type") == "view", "Transformed Data").otherwise("Parkingbay Data DQ").alias("check_name"),
        severity.alias("severity"),
        F.when(F.col("value") >= 5, F.col("user_id").cast("string")).otherwise("").alias("run_id"),
        F.col("props").alias("details"),
        F.col("ts").alias("timestamp"),
    )


STATUS = """SELECT CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
                   CASE WHEN event_type = 'view' THEN 'Transformed Data' ELSE 'Parkingbay Data DQ' END AS check_name,
                   CAST(user_id AS VARCHAR) AS run_id, props AS details, ts AS timestamp
            FROM events WHERE event_type NOT IN ('click', 'signup') AND value >= 5"""
NAMES = ["Parkingbay Data DQ", "Transformed Data"]


@query("dq_status", STATUS)
def status(spark, t):
    return dq_status(_traces(t), NAMES)


@query("dq_status_counts", f"SELECT status, count(*) AS count FROM ({STATUS}) GROUP BY status")
def status_counts(spark, t):
    return dq_status_counts(_traces(t), NAMES)
