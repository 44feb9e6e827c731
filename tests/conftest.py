import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    b = (SparkSession.builder.master("local[*]").appName("tidemark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidemark-warehouse-")))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their session: set a checkpoint folder only if none is configured.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-"))
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
