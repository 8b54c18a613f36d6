import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from vectable.workload.recipes import clear_kept  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("vectable-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    clear_kept(session)
    assert not session.catalog.listTables()
    session.stop()


@pytest.fixture
def uri(tmp_path):
    return str(tmp_path)
