import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskframe.session import get_spark
    s = get_spark("local[4]", app="riskframe-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):   # tests set their own only when unset
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="riskframe-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from oracle import duck
    return duck(SF_SMALL)
