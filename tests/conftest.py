import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="stocktake-tests-")
    session = (SparkSession.builder.master("local[4]").appName("stocktake-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.local.dir", scratch)
               .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint folder only when the session has none.
    if not session.sparkContext.getCheckpointDir() and not session.conf.get(
            "spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    yield session


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
