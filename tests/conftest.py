import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from factloom.session import local_session

    session = local_session(
        4, "tests",
        **{"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="test-")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Apply a Column function to a list of strings, in order."""
    from pyspark.sql import functions as F

    def run(function, values):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        return [r.out for r in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
