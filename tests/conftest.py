import tempfile

import pytest
from panelkit.operators import drop_scratch
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("panelkit-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelkit-checkpoints-"))
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples, missing values last."""

    def collect(df, *names):
        picked = df.select(*names) if names else df
        key = lambda r: tuple((v is None, str(v)) for v in r)
        return sorted((tuple(r) for r in picked.collect()), key=key)

    return collect
