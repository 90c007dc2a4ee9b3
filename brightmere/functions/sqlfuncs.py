"""Functions for use from SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from brightmere.functions.scalars import INVALID_STATUS, ORDER_STATUS
from brightmere.operators.joins import hierarchy
from brightmere.session import scratch_name

_CASES = " ".join(f"WHEN {code} THEN '{name}'" for code, name in ORDER_STATUS.items())


def register_sql_functions(
    spark: SparkSession, customers: str | None = None, categories: str | None = None
) -> None:
    """Create the session's SQL functions.

    ``order_status_text(code)`` is always there. ``customer_information(id)`` is a table
    function over ``customers (CustomerID, Name, Segment)``, ``all_categories()`` one over
    ``categories (ProductCategoryID, ParentProductCategoryID, Name)``; both name views or
    tables of the catalog. ``all_categories`` gives the tree as it is now: it is walked once,
    level by level without a bound, and stored in the shared folder.
    """
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION order_status_text(code INT) RETURNS STRING
            RETURN CASE code {_CASES} ELSE '{INVALID_STATUS}' END"""
    )
    if customers:
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION customer_information(wanted BIGINT)
                RETURNS TABLE (CustomerID BIGINT, Name STRING, Segment STRING)
                RETURN SELECT CustomerID, Name, Segment FROM {customers}
                       WHERE CustomerID = customer_information.wanted"""
        )
    if categories:
        tree = hierarchy(
            spark.table(categories), "ProductCategoryID", "ParentProductCategoryID", "Name"
        )
        view = scratch_name("all_categories")
        tree.createOrReplaceTempView(view)
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION all_categories()
                RETURNS TABLE (ParentProductCategoryName STRING, ProductCategoryName STRING,
                               ProductCategoryID BIGINT)
                RETURN SELECT parent_name, Name, ProductCategoryID FROM {view}"""
        )
