import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("feedloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def raw_small(spark, small):
    from feedloom.plans.fixtures import raw_edits

    return raw_edits(spark, small).cache()


@pytest.fixture(scope="session")
def landed(spark, small):
    from feedloom.plans.fixtures import land_raw_edits

    return land_raw_edits(spark, small)


def rows(df):
    """The rows of a frame in an order of their own, for comparison."""
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
