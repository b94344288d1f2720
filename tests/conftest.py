import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    tmp = tempfile.mkdtemp(prefix="spark-tests-")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC",
        "spark.local.dir": tmp, "spark.sql.warehouse.dir": f"{tmp}/warehouse", "spark.checkpoint.dir": f"file://{tmp}/shared", "spark.ui.showConsoleProgress": "false",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
