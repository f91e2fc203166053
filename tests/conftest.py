import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from adherence.session import build_session
    s = build_session("local[4]", "adherence-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh folder below the session's checkpoint folder."""
    from adherence.session import work_path
    return work_path(spark, "tests", unique=True)


@pytest.fixture()
def local_tmp():
    return tempfile.mkdtemp(prefix="adherence-test-")
