import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from newsledger.session import local_session
    s = local_session("*", 8)
    yield s
    s.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]


def one(spark, expr, value, schema="v string"):
    """Evaluate a Column builder on one value."""
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr(df["v"]).alias("r")).collect()[0]["r"]


def many(spark, expr, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r["r"] for r in df.select("i", expr(df["v"]).alias("r")).orderBy("i").collect()]
