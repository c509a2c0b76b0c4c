import os
import sys

import pytest

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HOME)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HOME, os.environ.get("PYTHONPATH", "")]))

from surveyloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tiny data: few partitions, and only the quick compiler of the JVM.
    quick = {"spark.sql.shuffle.partitions": "3", "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"}
    session = local_session(8, "6g", "surveyloom-tests", **quick)
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Small tables from rows and a schema; several partitions unless told otherwise."""
    def make(schema, *rows, parts=3):
        return spark.createDataFrame(list(rows), schema).repartition(parts)

    return make


@pytest.fixture
def rows():
    """Rows of a result as sorted plain tuples."""
    def collect(df, *columns):
        return sorted(
            (tuple(r) for r in df.select(*columns).collect()),
            key=lambda r: tuple((v is None, v) for v in r),
        )

    return collect
