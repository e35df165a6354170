import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shopflow.session import build_session
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shopflow-wh-")})
    # Tests set their own shared folder only where the session names none.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shopflow-chk-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_root(spark):
    from shopflow.session import fresh_dir
    return fresh_dir(spark, "test")
