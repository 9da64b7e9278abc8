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
    from flowlens.session import get_session
    extra = {}
    # tests run locally: give the session its own shared folder only when unset
    from pyspark.sql import SparkSession
    s = get_session("local[*]", shuffle_partitions=8, extra=extra)
    from flowlens.session import shared_dir
    shared_dir(s, "")
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="flowlens-t-")
