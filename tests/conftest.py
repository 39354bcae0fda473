import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from corpusflow.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="corpusflow-tests")
    yield s
    s.stop()


def col_values(spark, values, expr, schema="x string"):
    """Evaluate a Column builder over a one-column DataFrame; returns the list in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, " + schema)
    return [r[0] for r in df.orderBy("i").select(expr).collect()]
