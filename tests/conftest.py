import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from patronage.session import get_session
    conf = {}
    # tests set their own checkpoint folder only when none is configured
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="patronage-test-ckpt-")
    conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="patronage-test-warehouse-")
    s = get_session("local[4]", app_name="patronage-tests", shuffle_partitions=8, conf=conf)
    yield s
    s.stop()
