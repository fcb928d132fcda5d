import tempfile

import pytest
from pyspark.sql import SparkSession

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    """One small session; its scratch folders are in the system's temporary folder."""
    scratch = tempfile.mkdtemp(prefix="spark-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.local.dir", scratch)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"file://{scratch}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
