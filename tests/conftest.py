import glob
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__  # noqa: E402, F401  (registers plug-in functions by value)
from finetide.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for file in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{file}'")
    return con


@pytest.fixture
def many_files(spark):
    """As at scale, small shuffle partitions are not joined: sorted tables have several files."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan():
    return plan_of
