import pytest

from ledgerlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Evaluate one column over a single row."""
    def run(column):
        return spark.range(1).select(column.alias("v")).first()["v"]
    return run


@pytest.fixture
def rows():
    def run(df, *order):
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return run
