import os
import tempfile

import pytest
from pyspark.sql import SparkSession

from cinderfield.scratch import release

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cinderfield-test-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    assert not any(files for _, _, files in os.walk(session.conf.get("spark.checkpoint.dir")))
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
