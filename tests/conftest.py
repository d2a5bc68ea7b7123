import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="lodestar-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("lodestar-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lodestar-test-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
