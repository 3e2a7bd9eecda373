import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larder.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "larder-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def apply(spark):
    """Apply a column function to Python values, in order."""
    from pyspark.sql import functions as F

    def run(function, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i long, v {kind}")
        out = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
        return [r["out"] for r in out]

    return run
