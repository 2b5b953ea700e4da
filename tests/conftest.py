import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sluiceway import session  # noqa: E402

TESTDATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    built = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    built.sparkContext.setLogLevel("ERROR")
    yield session.configure(built)
    built.stop()


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in picked.collect()), key=repr)

    return collect


@pytest.fixture(scope="session")
def sf_dir():
    if not TESTDATA.exists():
        pytest.skip(f"{TESTDATA} is absent")
    return str(TESTDATA)
