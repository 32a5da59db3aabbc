from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    folder = tempfile.mkdtemp(prefix="spark-")
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.sql.warehouse.dir", f"{folder}/warehouse").config("spark.checkpoint.dir", f"{folder}/shared").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
