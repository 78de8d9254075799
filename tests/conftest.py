import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

from legajo.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a column function to Python values, keeping their order."""
    from pyspark.sql import functions as F

    def apply(fn, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}").repartition(4)
        # In two steps, so that fn reads a plain column.
        out = df.select("i", fn(F.col("v")).alias("out")).collect()
        return [r["out"] for r in sorted(out, key=lambda r: r["i"])]

    return apply
