import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TS1, TS2 = "2026-01-01 00:00:00", "2026-02-01 00:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("assaylake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def namespaces(spark):
    """Drop what a test leaves in the catalog; files stay in its own folder."""
    names = ("silver", "gold", "work")
    for n in names:
        spark.sql(f"DROP SCHEMA IF EXISTS {n} CASCADE")
    yield
    for n in names:
        spark.sql(f"DROP SCHEMA IF EXISTS {n} CASCADE")


def rows(df, *order):
    """Rows as a list of tuples, in a fixed order."""
    return sorted([tuple(r) for r in df.select(*(order or df.columns)).collect()], key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
