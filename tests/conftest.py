import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from corpusloom.session import configure

    builder = (SparkSession.builder.master("local[8]").appName("corpusloom-tests")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
