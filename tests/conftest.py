import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tablehaul-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def uri(tmp_path):
    return lambda name: str(tmp_path / name)


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def pushed_filters(df) -> str:
    """The scan's pushed filters, as the physical plan prints them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("PushedFilters: ")[1].split("], ReadSchema")[0]


def read_schema(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("ReadSchema: ")[1].splitlines()[0]
