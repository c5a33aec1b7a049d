import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("warehouse")
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(folder)).config("spark.checkpoint.dir", f"file://{folder}/shared").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    """The smallest test tables."""
    return "/root/testdata/sf0.001"
