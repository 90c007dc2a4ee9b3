import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from brightmere.session import session

    spark = session(
        "tests",
        "local[*]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture
def rows(spark):
    """Make a frame from rows and a layout."""
    return lambda data, ddl: spark.createDataFrame(data, ddl)


def values(df):
    """The rows of a frame as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
