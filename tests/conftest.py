import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from starlane.session import apply_engine_conf

    builder = (SparkSession.builder.master("local[4]").appName("starlane-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder only when the session has none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starlane-test-ckpt-"))
    apply_engine_conf(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="starlane-test-")
