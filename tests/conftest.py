import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session, shared_dir
    s = local_session(cores="*", shuffle_partitions=8, app="tessera-tests")
    shared_dir(s)  # tests set their own checkpoint folder when none is configured
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tessera-test-")
