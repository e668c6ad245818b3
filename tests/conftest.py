from contextlib import redirect_stdout
from io import StringIO

import pytest
from pyspark.sql import SparkSession


def plan_text(df):
    """What ``explain`` prints."""
    out = StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(shared))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")
