import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


def pytest_configure():
    """The session starts first, since test modules build column expressions when they load."""
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SparkSession.getActiveSession()


@pytest.fixture
def values(spark):
    """Evaluate a column expression for a list of texts."""

    def run(expression, texts, schema="c string"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {schema}")
        return [r[0] for r in df.orderBy("i").select(expression).collect()]

    return run


def rows(df, *columns):
    picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(str(x) for x in r))
