import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ampwise.session import checkpoint_dir, get_session
    s = get_session("local[*]", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ampwise-wh-")})
    checkpoint_dir(s, tempfile.mkdtemp(prefix="ampwise-ckpt-"))
    yield s


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="ampwise-test-")
