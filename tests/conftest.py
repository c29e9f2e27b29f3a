import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from reviewloom.session import local_session

    session = local_session(8, "8g", "tests")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_left():
    """What the tests of a module kept in memory is no concern of the next module's."""
    yield
    from pyspark import SparkContext

    context = SparkContext._active_spark_context
    for kept in list(context._jsc.getPersistentRDDs().values()) if context else []:
        kept.unpersist()


@pytest.fixture
def rows(spark):
    """rows(ddl, tuple, ...) -> DataFrame"""

    def make(ddl, *values):
        return spark.createDataFrame(list(values), ddl)

    return make
