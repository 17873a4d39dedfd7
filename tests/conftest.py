import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mendlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__driver__memory="4g", spark__driver__bindAddress="127.0.0.1", spark__driver__host="127.0.0.1",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of an expression over a list of texts."""
    from pyspark.sql import functions as F

    def run(expression, values):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, c string").repartition(2)
        return [r["v"] for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]

    return run
