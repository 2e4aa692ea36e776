import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

TESTS = Path(__file__).resolve().parent
sys.path.insert(0, str(TESTS.parent))
# Python workers import the package and the decoders of the tests.
os.environ["PYTHONPATH"] = os.pathsep.join([str(TESTS.parent), str(TESTS), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("episodica-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
