import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"file://{home}/shared", "spark.sql.warehouse.dir": f"file://{home}/warehouse",
        "spark.driver.memory": "4g", "spark.local.dir": f"{home}/local",
    }
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
