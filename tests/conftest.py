import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import check  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return check.session("8")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def con(sf_dir):
    return check.connect(sf_dir)


@pytest.fixture
def one(spark):
    """Evaluate a column function over a list of values of one type."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
