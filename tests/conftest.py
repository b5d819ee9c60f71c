import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reuselens.session import get_spark
    s = get_spark("local[4]", app="reuselens-tests", shuffle_partitions=4)
    # tests only: a scratch checkpoint folder (a cluster names a shared one)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="reuselens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="reuselens-test-")
