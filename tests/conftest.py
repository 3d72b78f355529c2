import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("searchmill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def mart(spark, tmp_path):
    """A fresh pair of tables."""
    import uuid

    from searchmill import Mart, create_layers

    tag = uuid.uuid4().hex[:8]
    mart = Mart(f"rdl_{tag}.webm_excel", f"ppl_{tag}.webmaster_aggregated")
    create_layers(spark, mart, str(tmp_path / "tables"))
    return mart
