import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session
    s = local_session(8, app="tessera-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    """A fresh folder below the session's work root."""
    from tessera.session import fresh_dir
    return fresh_dir(spark, "test")
